import numpy as np
from pyspark.sql import functions as F

from cinerank.llm import language
from tests.llm.texts import empty

GERMAN = "der die das und nicht mit einer schönen großen Straße über die Brücke zur Kirche"
ENGLISH = "the quick brown fox jumps over the lazy dog and walks down to the river with them"


def model(spark):
    rows = [(k, f"{t} {k}", lang) for k in range(8) for t, lang in ((GERMAN, "de"), (ENGLISH, "en"))]
    return language.fit(spark.createDataFrame([*rows, (99, None, "de"), (98, "no language", None)], "doc_id long, text string, lang string"))


def page(lang, text):
    return f"<html lang='{lang}'><head><style>und und</style><script>der()</script></head><p>{text}</p><!-- und --></html>"


def pages(spark):
    rows = [(k, f"http://www.site.de/{k}", page("de", GERMAN)) for k in range(6)]
    rows += [(10 + k, f"http://news.example.com/{k}", page("en", ENGLISH)) for k in range(6)]
    rows += [(20, "http://www.site.de/x", page("de", "")), (21, "http://news.example.com/x", None), (22, None, page("en", ENGLISH)),
             (23, "http://www.site.de/y", page("en", GERMAN)), (24, None, None), (None, "no url", ""), (0, "http://www.site.de/0", page("de", GERMAN))]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, host string, text int")


def test_evidence_is_fused(spark):
    out = language.identify(pages(spark), model(spark)).collect()
    got = {r["page_id"]: r["lang"] for r in out}
    assert len(out) == 19
    assert all(got[k] == "de" for k in (0, 1, 5, 20, 23)) and all(got[k] == "en" for k in (10, 15, 21, 22))
    assert all(0 <= r["chance"] <= 1 for r in out)
    assert {r["declared"] for r in out} == {"de", "en", ""}


def test_nothing_to_learn_or_to_judge(spark):
    none = language.fit(empty(spark))
    assert none.languages == []
    assert {r["lang"] for r in language.identify(pages(spark), none).collect()} == {None}
    assert language.identify(pages(spark).limit(0), model(spark)).collect() == []


def test_copies_take_no_places_in_the_sample(spark):
    texts = spark.range(20).select(F.concat(F.lit(GERMAN + " "), F.col("id")).alias("text"), F.lit("de").alias("lang"))
    first = texts.orderBy(F.xxhash64("text")).limit(1)
    copies = texts.union(first.crossJoin(spark.range(50)).select("text", "lang"))
    once, with_copies = (language.fit(t, per_language=10) for t in (texts, copies))
    assert np.array_equal(once.chances, with_copies.chances)


def test_held_out_pages(spark):
    from cinerank.llm.queries import op4_language
    from pyspark.sql import functions as F

    sf_dir = "/root/testdata/sf0.001"
    where = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.regexp_extract("url", "://[^/]*/([a-z]{2})/", 1).alias("dir"))
    out = op4_language(spark, sf_dir).join(where, "page_id")
    assert out.where("lang = dir").count() >= 0.95 * out.count() > 0
