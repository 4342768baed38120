import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.llm import leaks

ITEM = "Some 75 violins, each more porous than the last, were weighed by the locksmith reluctantly. Why was the clockwork along the northern ridge inspected under protest by one sunken midwife?"
ZH = "石匠为什么要照旧押送染坊二楼那88只空荡的铁砧？到了第93年，精巧的竹简终于由郎中押送，送往驿道拐角旁的瓦当铺。"


def found(spark, docs, items=((1, ITEM, "en"), (2, ZH, "zh"), (3, "too short", "en"), (4, None, None))):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id int, body string").withColumn("text", F.lit("clash")).withColumn("item", F.lit(1))
    i = spark.createDataFrame(list(items), "item_id long, text string, lang string")
    return {(r.doc_id, r.item_id) for r in leaks.find_leaks(d, "doc_id", "body", i, "item_id", "text", "lang").collect()}


def test_cases(spark):
    w = ITEM.split()
    half = len(leaks.words(leaks.level(ITEM))) // 2
    docs = {
        "whole": f"Before. {ITEM} After.", "shouting": ITEM.upper().replace(" ", "  \n"), "wide": "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in ITEM), "emphasis": f"**{ITEM[:60]}**<b>{ITEM[60:]}</b>", "invisible": "​".join(ITEM),
        "reordered": " ".join(w[15:] + ["and"] + w[:15]), "remark": " ".join(w[:8] + ["(so the menu says)"] + w[8:]), "exchanged": " ".join(x if k % 9 != 4 else "carpet" for k, x in enumerate(w)), "zh": f"好。{ZH}好。", "zh spaced": " ".join(ZH), "zh half": ZH[:30],
    }
    none = {"null": None, "empty": "", "less than half": " ".join(w[: half - 2]), "scattered": " ".join(x if k % 4 else "carpet" for k, x in enumerate(w)), "zh less": ZH[:20], "symbols": "?!。"}
    got = found(spark, [*docs.values(), *none.values()])
    assert got == {(k, 2 if n.startswith("zh") else 1) for k, n in enumerate(docs)}


def test_long_text_and_blocks(spark, monkeypatch):
    random.seed(1)
    noise = " ".join(random.choice(ITEM.split()) for _ in range(60_000))
    docs = [noise + " " + ITEM + " " + noise, noise, ITEM * 50]
    assert found(spark, docs) == {(0, 1), (2, 1)}
    monkeypatch.setattr(leaks, "SMALL_ITEMS", 10)
    assert found(spark, docs) == {(0, 1), (2, 1)}
    assert found(spark, docs, ()) == set() and found(spark, []) == set()


def greedy(a, b, m):
    """Greedy string tiling in its textbook form: the longest common unmarked stretch, again and again."""
    ua, ub, total = [False] * len(a), [False] * len(b), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not ua[i + k] and not ub[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < m:
            return total
        k, i, j = best
        ua[i : i + k] = ub[j : j + k] = [True] * k
        total += k


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=30), st.lists(st.integers(0, 4), max_size=20), st.integers(2, 4))
def test_tiling(a, b, m):
    seeds = [(i, j) for i in range(len(a) - m + 1) for j in range(len(b) - m + 1) if a[i : i + m] == b[j : j + m]]
    tiles = leaks.tile(seeds, m)
    places = [p for i, _, n in tiles for p in range(i, i + n)]
    assert len(places) == len(set(places)) and all(a[i : i + n] == b[j : j + n] and n >= m for i, j, n in tiles)
    want = greedy(a, b, m)
    assert not tiles or tiles[0][2] == max(n for _, _, n in tiles)
    assert abs(sum(n for _, _, n in tiles) - want) <= max(0, len(b) // 2) and (want > 0) == bool(tiles)


def test_index_equals_plain_search():
    random.seed(3)
    items = [(k, [random.choice("abcdef") for _ in range(20)]) for k in range(10)]
    docs = [[random.choice("abcdefg") for _ in range(random.randrange(60))] + items[k % 10][1][3:15] for k in range(20)]
    got = {(d, i): n for d, i, n in leaks.Index(items, 4).search(docs)}
    for d, doc in enumerate(docs):
        for i, item in items:
            seeds = [(x, y) for x in range(len(doc) - 3) for y in range(len(item) - 3) if doc[x : x + 4] == item[y : y + 4]]
            assert got.get((d, i), 0) == sum(n for *_, n in leaks.tile(seeds, 4))
