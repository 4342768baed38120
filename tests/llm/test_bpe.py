import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.llm import bpe

tiktoken = pytest.importorskip("tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(bpe.VOCABULARY), reason="no vocabulary file")


@pytest.fixture(scope="module")
def pair():
    e = bpe.Encoder()
    pattern = bpe.PATTERN.replace(r"\p{White_Space}", r"\s").replace(r"\P{White_Space}", r"\S").replace(r"[^\s\p{L}", r"[^\s\p{L}")
    return e, tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=e.ranks, special_tokens={})


TEXTS = ["", " ", "Hello, world", "It's <|endoftext|> we'll-see", "  two   spaces \n\n end ", "第1桌靠窗，冬天鲜甜。", "naïve—façade ¼ℓ①", "👨‍👩‍👧🙏🏽", "สวัสดีครับ", "नमस्ते दुनिया", "مرحبا", "‮abc‬﻿\x00", "a" * 5_000, "字" * 2_000, "x" * 300 + " " * 400]


@pytest.mark.parametrize("text", TEXTS)
def test_against_reference(pair, text):
    assert pair[0].encode(text) == pair[1].encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_random_text(pair, text):
    ids = pair[0].encode(text)
    assert ids == pair[1].encode_ordinary(text)
    back = {v: k for k, v in pair[0].ranks.items()} if not hasattr(pair[0], "back") else pair[0].back
    pair[0].back = back
    assert b"".join(back[i] for i in ids).decode() == text


def test_short_and_long_merges_agree(pair):
    random.seed(2)
    for _ in range(200):
        w = "".join(random.choice("abtheing字漢éสวั") for _ in range(random.randrange(1, 400))).encode()
        assert pair[0].merge_short(w) == pair[0].merge_long(w)


def test_frame(spark, pair):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)] + [(90, None), (1, "again")], "doc long, body string").withColumn("text", F.lit("clash")).withColumn("ids", F.lit(1))
    got = sorted((r.doc, tuple(r.ids)) for r in bpe.encode_texts(df, "doc", "body").collect())
    assert got == sorted((k, tuple(pair[0].encode(t))) for k, t in [*enumerate(TEXTS), (90, None), (1, "again")])
    assert bpe.encode_texts(df.limit(0), "doc", "body").count() == 0
