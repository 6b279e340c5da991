"""NULLs in any column, empty and very long texts, ties and repeated rows, empty tables, extra columns with clashing names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from venuelake.llm import decontaminate, html_trees, langid, line_dedup, maxent_lm, near_dedup, perplexity_rules, pii_crf, quality_crf, stages
from venuelake.llm.bpe import encode_documents

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "Some words of a very long line that goes on and on, again. " * 6000
ROWS = [
    (1, "The same text, with enough words in it to be compared with others by every operator here.", "en", "s", 1), (1, "The same text, with enough words in it to be compared with others by every operator here.", "en", "s", 1),
    (2, "The same text, with enough words in it to be compared with others by every operator here.", None, None, None), (3, None, "en", "s", 0), (4, "", "de", "s", 0), (5, " \n\t\n ", "fr", "s", 4),
    (None, "A text without an id, which has some words of its own, too.", "en", "s", 9), (6, LONG, "en", "s", len(LONG)), (7, "12 34 !! --", "es", "s", 11), (8, "Ein anderer Satz, mit Wörtern auf Deutsch und ohne weiteren Sinn.", "de", "s", 60),
]
CLASH = ["score", "predicted", "held_out", "component_id", "kept", "key", "node", "root", "rep", "a", "b", "line", "mark", "model", "token", "row", "gone", "n_tokens", "kept_0", "rank"]


@pytest.fixture(scope="module", params=["rows", "empty", "clash"])
def docs(request, spark):
    df = spark.createDataFrame(ROWS if request.param != "empty" else [], SCHEMA)
    return df.withColumns({c: F.lit(f"x{i}") for i, c in enumerate(CLASH)}) if request.param == "clash" else df


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (8, 0, None), (6, 1, 0), (None, 1, 1), (99, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def check_rows(docs, df):
    """One row for each row."""
    got = by_id(df)
    assert {k: len(v) for k, v in got.items()} == ({r.doc_id: docs.where(F.col("doc_id").eqNullSafe(F.lit(r.doc_id))).count() for r in docs.select("doc_id").distinct().collect()})
    return got


def test_quality(docs, labels):
    got = check_rows(docs, quality_crf.classify(docs, labels))
    if got:
        assert got[3][0].score == got[4][0].score == got[5][0].score and got[1][0] == got[1][1]
    check_rows(docs, quality_crf.classify(docs, labels.limit(0)))


def test_near(docs):
    got = check_rows(docs, near_dedup.near_groups(docs))
    if got:
        assert got[2][0].component_id == 1 and not got[2][0].kept and all(r.kept for r in got[1])
        assert got[3][0].n_shingles == got[5][0].n_shingles == 0 and got[3][0].kept and got[3][0].component_id == 3
        assert got[None][0].component_id is None and got[None][0].kept and got[6][0].kept


def test_lm(docs):
    got = check_rows(docs, maxent_lm.score_texts(docs))
    if got:
        assert got[3][0].n_tokens == got[5][0].n_tokens == 1 and got[1][0].score == got[1][1].score


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([(1, "same text with enough words in it to be"), (2, None), (3, ""), (None, "Ein anderer Satz mit Wörtern auf Deutsch"), (4, "the"), (1, "same text with enough words in it to be")], "item_id long, text string")
    rows = decontaminate.contaminated(docs, bench).collect()
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    if docs.count():
        assert sorted((r.doc_id, r.item_id or -1, r.distance) for r in rows) == [*[(1, 1, 0)] * 4, *[(2, 1, 0)] * 2, (8, -1, 0)]
        assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 4, 5, 6, 7]
    else:
        assert not rows
    assert decontaminate.clean(docs, bench.limit(0)).count() == docs.count()


def test_bpe(docs):
    got = check_rows(docs, encode_documents(docs, public_tokenizers.path("word_bpe_49k.json")))
    if got:
        assert got[3][0].n_tokens == got[4][0].n_tokens == got[5][0].n_tokens == 0 and got[1][0] == got[1][1]


def test_pii(docs):
    check_rows(docs, pii_crf.find(docs))


def test_language(docs):
    got = check_rows(docs, langid.identify(docs))
    if got:
        assert {got[i][0].lang_pred for i in (3, 4, 5, 7)} == {"und"} and got[3][0].score == 0


def test_rules(docs):
    got = check_rows(docs, perplexity_rules.judge(docs))
    if got:
        assert got[3][0].n_words == 0 and got[3][0].base_failed and not got[3][0].kept


def test_lines(docs):
    got = check_rows(docs, line_dedup.dedup_lines(docs))
    if got:
        assert got[2][0].text == "" and got[2][0].n_removed == 1 and got[1][0].n_removed == got[1][1].n_removed == 0
        assert got[3][0].text is None and got[4][0].text == "" and got[None][0].n_removed == 0 and got[6][0].text == LONG


def test_pages(spark):
    page = "<html><body><article><p>Text of a page.</p></article></body></html>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "v", ""), (None, "w", "<div>x"), (4, "x", "<p>" + "long words " * 40_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("t"), "n_chars": F.lit(1), "mark": F.lit(2)})
    got = sorted((r.page_id or 0, r.text) for r in html_trees.extract_pages(df).collect())
    assert [g[0] for g in got] == [0, 1, 1, 2, 3, 4] and got[1] == got[2] == (1, "Text of a page.") and got[3] == (2, "") and got[4] == (3, "")
    assert html_trees.extract_pages(df.limit(0)).count() == 0


def test_stages_return_documents(spark, docs):
    columns = SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    for name, apply in corpus_pipeline.STAGES[:-1]:
        out = apply(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == columns, name
        assert out.count() <= docs.count()


def test_stage_order():
    assert [f for _, f in corpus_pipeline.STAGES] == [stages.quality, stages.lines, stages.near_duplicates, stages.decontamination, stages.encoding]


def test_pipeline_is_its_stages_one_by_one(spark):
    """The result on the smallest tables, held against the operators' own results."""
    from tests.llm.test_operators import brute_components, brute_lines

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = {r.doc_id for r in quality_crf.classify(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in good)
    left = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = {d: t for d, t in left.items() if t.split() or t == dict(rows)[d]}
    single = {d for d, (_, _, kept) in brute_components(texts, 5, 80).items() if kept}
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    leaks = {r.doc_id for r in decontaminate.contaminated(spark.createDataFrame([(d, texts[d]) for d in single], "doc_id long, text string"), bench).collect()}
    got = {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == single - leaks and got
