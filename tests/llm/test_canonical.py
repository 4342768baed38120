import random

import pytest
from pyspark.sql import functions as F

from tidewell.llm import canonical

BRANDS = [(1, "檀塘汀社", "Taosklin", "火锅"), (2, "Dorgrilin", None, "面馆"), (3, "Dorgrilin Select", "屿篱局优选", "奶茶"), (4, "禾桐茉", "Pelquizan", "咖啡"), (5, "酥汀记", "Mopelche", "书店"), (6, "枳釉社", "Daevixzan", "健身"), (7, "枳釉社烘焙房", "Daevixzan Bakery", "健身"), (8, None, None, "x")]
VALUES = {
    "檀 塘 汀 社": 1, "谈塘汀社": 1, "檀塘汀汀社": 1, "【檀塘汀社】": 1, "南陌市檀塘汀社": 1, "南陌大学城檀塘汀社🔥": 1, "Taoskiln（大学城店）": 1, "品牌：檀塘汀社/加盟": 1, "檀塘汀社商贸有限公司(老城46号店)": 1, "ｔａｏｓｋｌｉｎ": 1, "taosklin面馆": 1,
    "DORGRILIN": 2, "Dorgriiln​": 2, "dorgrilin  火锅": 2, "Dor-grilin": 2, "Dorgrilin Selct": 3, "DorgrilinSelect 大学城": 3, "屿籬局优选": 3, "禾桐莫": 4, "1.禾桐茉(Pelquizan": 4, "Pelquizan™ Co., Ltd.": 4, "★酥汀記": 5, "酥汀记 Mopelche": 5, "枳釉社烘焙房房": 7, "枳釉社官方": 6,
    "三叔羊肉粉": None, "禾桐鲤": None, "蔓汀曦岚（大学城）": None, "其他": None, "-": None, "Linprufen": None, "x" * 5_000: None,
}


def mapped(spark, values, brands=BRANDS):
    df = spark.createDataFrame([(v,) for v in values], "typed string").withColumn("value", F.lit("clash")).withColumn("core", F.lit("clash"))
    extra = spark.createDataFrame([(f"店{k}（{p}）",) for k in range(30) for p in ("大学城店", "老城3号店")], "typed string").withColumn("value", F.lit(1)).withColumn("core", F.lit(1))
    listed = spark.createDataFrame(brands, "name long, brand_nm string, alias_nm string, cat_nm string")
    cities = spark.createDataFrame([("南陌市",), ("海岑",), (None,)], "c string")
    got = canonical.map_values(df.unionByName(extra.withColumn("value", F.lit("clash")).withColumn("core", F.lit("clash"))), "typed", listed.withColumnRenamed("name", "bid"), "bid", ["brand_nm", "alias_nm"], cities, "cat_nm")
    return {r.typed: r.bid for r in got.collect()}


def test_values(spark):
    got = mapped(spark, [*VALUES, None, "", " \t", "檀 塘 汀 社"])
    assert {v: got[v] for v in VALUES} == VALUES and None not in got and "" not in got and " \t" not in got


@pytest.mark.parametrize("names, words", [(0, 200_000), (20_000, 0), (0, 0)])
def test_longer_lists_and_more_words_give_the_same(spark, monkeypatch, names, words):
    monkeypatch.setattr(canonical, "SMALL_LIST", names)
    monkeypatch.setattr(canonical, "WORDS", words)
    got = mapped(spark, VALUES)
    assert {v: got[v] for v in VALUES} == VALUES


def test_best_jaccard_without_refinement(spark):
    listed = spark.createDataFrame([(1, "north harbour tea"), (2, "north harbour tea house"), (3, "south gate books")], "i int, n string")
    values = spark.createDataFrame([("North Harbour Teas",), ("harbour tea house",), ("south gate book shop",), ("nothing like it",)], "v string")
    for small in (20_000, 0):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(canonical, "SMALL_LIST", small)
            got = {r.v: r.i for r in canonical.map_values(values, "v", listed, "i", ["n"], refine=False).collect()}
        assert got == {"North Harbour Teas": 1, "harbour tea house": 2, "south gate book shop": 3, "nothing like it": None}


def test_another_list(spark):
    """Recall and precision on a list in other words and characters than the project's."""
    rng = random.Random(4)
    syllables, signs = "ba ko ri mun tel sha vo pir gan lue dor fi".split(), "春江花月夜流水亭台楼阁松柏竹梅清风明玉石泉溪谷雪霜秋冬晨暮"
    names = sorted({"".join(rng.sample(syllables, 3)).capitalize() for _ in range(60)} | {"".join(rng.sample(signs, rng.choice((4, 5)))) for _ in range(60)})
    listed, outside = names[::2], names[1::2]
    sound = canonical.script(spark).sound
    alike = {}
    for c, stands in sound.items():
        if 0x4E00 <= c < 0x9FA6:
            alike.setdefault(stands, []).append(chr(c))

    def typed(name):
        kind = rng.randrange(6)
        k = rng.randrange(1, len(name) - 1)
        if kind == 0:
            return f"【{name.upper()}】 "
        if kind == 1:
            return f"临安市{name}有限公司"
        if kind == 2:
            return name[:k] + name[k] + name[k:]  # a key hit twice
        if kind == 3 and not name.isascii():
            return name[:k] + rng.choice(alike[sound.get(ord(name[k]), name[k])]) + name[k + 1 :]
        if kind == 4 and name.isascii():
            return name[:k] + name[k + 1] + name[k] + name[k + 2 :]
        return f"品牌：{name}（官方）"

    truth = {typed(n): n for n in listed for _ in range(4)} | {typed(n): None for n in outside for _ in range(2)}
    values = spark.createDataFrame([(v,) for v in truth], "v string")
    cities = spark.createDataFrame([("临安",)], "c string")
    got = {r.v: r.n for r in canonical.map_values(values, "v", spark.createDataFrame([(n,) for n in listed], "n string"), "n", ["n"], cities).select("v", "n").collect()}
    right = sum(1 for v, n in truth.items() if n and got[v] == n)
    recall, precision = right / sum(1 for n in truth.values() if n), right / sum(1 for n in got.values() if n)
    print("recall", recall, "precision", precision)
    assert recall >= 0.9 and precision >= 0.95


def test_empty_list(spark):
    assert set(mapped(spark, ["a", "b"], [(9, None, None, None)]).values()) == {None}


def test_no_values(spark):
    assert all(v is None for v in mapped(spark, [None, ""]).values())


@pytest.mark.parametrize("similar", [0.4, 0.5, 0.7])
def test_prefix_filter_loses_nothing(similar):
    """The filters of the join, in plain Python, against comparing all with all."""
    import math

    random.seed(9)
    words = ["".join(random.choice("abcd") for _ in range(random.randrange(2, 9))) for _ in range(120)]
    sets = {w: canonical.tokens(w) for w in words}
    freq = {}
    for t in sets.values():
        for x in t:
            freq[x] = freq.get(x, 0) + 1
    order = {w: sorted(t, key=lambda x: (freq[x], x)) for w, t in sets.items()}
    for a in sets:
        for b in sets:
            x, y = order[a], order[b]
            common = len(set(x) & set(y))
            if common / (len(x) + len(y) - common) < similar - canonical.EPS:
                continue
            px, py = (len(s) - math.ceil(len(s) * similar - canonical.EPS) + 1 for s in (x, y))
            need = math.ceil(similar / (1 + similar) * (len(x) + len(y)) - canonical.EPS)
            hits = [(i, y.index(t)) for i, t in enumerate(x[:px]) if t in y[:py]]
            assert any(min(i, j) + min(len(x) - i, len(y) - j) >= need for i, j in hits) and len(x) * similar - canonical.EPS <= len(y) <= len(x) / similar + canonical.EPS


@pytest.mark.parametrize("small", [20_000, 0])
def test_characters_of_several_readings(spark, monkeypatch, small):
    """A typed character may stand for any of its readings, as may one of the list; the first reading goes before the others."""
    monkeypatch.setattr(canonical, "SMALL_LIST", small)
    listed = spark.createDataFrame([(1, "金橘园"), (2, "月山居"), (3, "泐山居"), (4, "柏悦轩"), (5, "春江橘子"), (6, "都会里")], "i int, n string")
    truth = {
        "金桔园": 1, "【金 桔 园】有限公司": 1, "金桔桔园": 1, "金結园": None, "乐山居": 3, "约山居": 2, "伯月轩": 4, "摆乐轩": 4, "搏悦轩": 4, "拜悦轩": 4, "宝悦轩": None, "春桔江子": 5, "春江桔": 5, "抖快里": 6, "重会里": None, "桔" * 3_000: None,
    }
    values = spark.createDataFrame([(v,) for v in truth], "v string")
    got = {r.v: r for r in canonical.map_values(values, "v", listed, "i", ["n"]).collect()}
    assert {v: got[v].i for v in truth} == truth and got["金桔园"].jaccard == 1


def test_prefix_filter_loses_no_reading():
    """The index against comparing all with all, with characters of two and three readings."""
    rng = random.Random(6)
    readings = {"x": "ab", "y": "bcd", "z": "da"}
    words = sorted({"".join(rng.choice("abcdefxyz") for _ in range(rng.randrange(2, 8))) for _ in range(300)})
    for similar in (0.4, 0.5, 0.7):
        index = canonical.NameIndex([(k, w, w, w) for k, w in enumerate(words)], similar, readings)
        for a in words[::3]:
            pairs = {k: canonical.read_alike(a, b, readings) for k, b in enumerate(words)}
            assert not any(set(c + e) & set(readings) for c, e, _ in pairs.values())
            wanted = {k: canonical.likeness(c, e) for k, (c, e, _) in pairs.items()}
            assert {hit[0]: hit[1] for hit in index.search(a)} == {k: j for k, j in wanted.items() if j >= similar - canonical.EPS}
