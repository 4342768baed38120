"""The registered html query against html.unescape."""

import html
import re

from tidewell.plans import reference_queries


def test_html_query_is_whole(spark, tmp_path):
    texts = ["<b>plain</b> text", "R&amp;D &eacute;t&#233; &#x1F600;", "&lt;i&gt;gone&lt;/i&gt; &notit; a & b", "&amp;lt;p&amp;gt;", None, "", "&nbsp;&copy 2020"]
    spark.createDataFrame(list(enumerate(texts)), "review_id long, text string").write.parquet(str(tmp_path / "amazon_new_review.parquet"))
    got = dict(map(tuple, reference_queries.text_html(spark, str(tmp_path)).collect()))
    assert got == {k: None if t is None else re.sub("<[^>]+>", "", html.unescape(t)) for k, t in enumerate(texts)}
