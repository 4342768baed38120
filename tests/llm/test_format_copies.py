import pytest
from pyspark.sql import functions as F

from tidewell.llm.format_copies import canonical_text, collapse

SAME = [
    ("Works  fine.", "works fine!!", "<p>Works fine</p>", "Ｗｏｒｋｓ　ｆｉｎｅ", "“works​ fine”", "WORKS\nFINE 👍", "Works&nbsp;fine", "Works fine :)", "**Works** fine", "&lt;p&gt;Works fine&lt;/p&gt;"),
    ("Fit: snug\nDays used: 267\nTaste: sweet", "Taste: sweet | Fit: snug | Days used: 267", "days used: 267 / FIT: SNUG / taste: sweet", "Taste：sweet；Days used：267；Fit：snug", "Days used: 267, Fit: snug, Taste: sweet", "<p>Fit: snug<br />Taste: sweet<br />Days used: 267</p>", "“Fit: snug; Days used: 267; Taste: sweet.”"),
    ("café", "café", "CAFÉ"), ("第1次。", "第１次"), ("Don't & won't", "Don’t &amp; won’t"), ("a < b", "a &lt; b"),
]
DIFFERENT = [("Works fine", "Works fine too"), ("For $34", "For $33"), ("Fit: snug; Taste: sweet", "Fit: sweet; Taste: snug"), ("用了1年", "用了9年"), ("cafe", "café"), ("a: b", "b: a"), ("कि", "की")]


@pytest.mark.parametrize("texts", SAME)
def test_same(texts):
    assert len({canonical_text(t) for t in texts}) == 1, [canonical_text(t) for t in texts]


@pytest.mark.parametrize("a,b", DIFFERENT)
def test_different(a, b):
    assert canonical_text(a) != canonical_text(b)


def test_nothing_to_compare():
    assert [canonical_text(t) for t in (None, "", " \n", "?!", "👍", "<br>", "​")] == [None] * 7


def frame(spark):
    rows = [(5, "u", "a", "Hot!"), (3, "u", "a", "hot"), (9, "u", "a", "HOT."), (9, "u", "a", "HOT."), (4, "u", "a", "cold"), (8, "v", "a", "hot"), (7, "u", "b", "hot"), (1, None, "a", "hot"), (2, "u", None, "hot"), (6, "u", "a", None), (10, "u", "a", "👍"), (11, "u", "a", "👍"), (12, "w", "a", "x" * 200_000), (13, "w", "a", "X" * 200_000)]
    rows += [(100 + k, "z", "c", "same") for k in range(300)]
    return spark.createDataFrame(rows, "review_id long, who string, asin string, body string").withColumn("id", F.lit("clash")).withColumn("keep_id", F.lit(0))


@pytest.mark.parametrize("hot", [None, 2, 100])
def test_collapse(spark, hot):
    members, sets = collapse(frame(spark), ["who", "asin"], "body", "review_id", hot)
    got = {(r.keep_id, r.copy_id) for r in members.collect()}
    assert got == {(3, 5), (3, 9), (12, 13)} | {(100, 100 + k) for k in range(1, 300)}
    assert {(r.who, r.keep_id, r.n_copies) for r in sets.collect()} == {("u", 3, 3), ("u", 4, 1), ("v", 8, 1), ("u", 7, 1), ("w", 12, 2), ("z", 100, 300)}


def test_empty(spark):
    members, sets = collapse(frame(spark).limit(0), ["who"], "body", "review_id")
    assert members.count() == 0 and sets.count() == 0


WRAPPED = [
    ("Days used: 231 | Smell: none | Fit: boxy", "Days\nused: 231 | Smell: none | Fit: boxy", "Fit:\nboxy, Days used: 231, Smell: none", "Smell: none, Days\nused: 231, Fit: boxy", "Smell: none / Fit: boxy / Days\r\nused: 231", "Smell:\nnone;\nFit: boxy; Days used: 231", "Smell:\nnone\nDays\nused: 231\nFit: boxy", "<p>Fit:<br>boxy; Smell: none; Days\nused: 231</p>"),
    ("Weight: 1 kg\nFit: snug", "Weight: 1\nkg\nFit: snug", "Fit: snug | Weight: 1\nkg", "Fit: snug\nWeight: 1\nkg"),
    ("Fit: snug, soft\nTaste: sweet", "Taste: sweet; Fit: snug, soft"), ("Fit: snug / Noise: low\nTaste: sweet", "Taste: sweet\nFit: snug\nNoise: low"),
]


@pytest.mark.parametrize("texts", WRAPPED)
def test_line_breaks_inside_parts(texts):
    assert len({canonical_text(t) for t in texts}) == 1, [canonical_text(t) for t in texts]


def test_line_breaks_part_values():
    assert canonical_text("Fit:\nsnug | Taste: sweet") != canonical_text("Fit:\nsweet | Taste: snug")
    assert canonical_text("I bought two.\nPros: light\nCons: none") == canonical_text("I bought two. Pros: light Cons: none")


def test_invisible_marks_and_fillers():
    want = canonical_text("ab")
    for c in ("\ufe0f", "\u034f", "\u3164", "\u115f", "\uffa0", "\u200b", "\u00ad", "\U000e0101", "\u180b"):
        assert canonical_text(f"a{c}b") == want, repr(c)
    assert canonical_text("e\u0301") == canonical_text("é") != canonical_text("e")


def test_only_tags_are_markup():
    assert canonical_text("x<y and z>w") == "xyandzw" != canonical_text("xw")
    assert canonical_text("if a <b then c> d") != canonical_text("if a d")
    for t in ("so<br>good", "so<br/>good", '<p class="a b">so</p> good', "<b>so</b> <a href='x' target=_blank>good</a>", "so <!-- no -->good", "<input disabled>so good", "<BR />so good"):
        assert canonical_text(t) == "sogood", t


def test_labelled_parts_behind_invisible_characters_and_end_marks():
    want = canonical_text("Smell: oily; Weight: 210 g; Days used: 238")
    for t in ("Smell:\u200b oily,\u200b Weight: 210 g, Days used: 238", "Days used: 238.. Weight: 210 g.. Smell: oily!!!", "Weight: 210 g! Smell: oily. Days used: 238.", "Days used: 238 - Weight: 210 g – Smell: oily", "• Smell: oily • Days used: 238 • Weight: 210 g"):
        assert canonical_text(t) == want, t
    assert canonical_text("non-stick: yes; anti-rust: no") == canonical_text("anti-rust: no - non-stick: yes")
    assert canonical_text("It was 3.5: fine. Good") != canonical_text("Good. It was 3.5: fine")
