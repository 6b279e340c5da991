"""Sidebars, menus and forms inside an article are left out whether or not their attributes say so."""

from venuelake.llm import html_trees


def test_closed_tags_inside_the_article(spark):
    p = "The council met on Monday to discuss the new bridge, and after a long debate the members agreed to build it next year."
    page = f"<html><body><article><p>{p}</p><aside><p>{p} Side.</p></aside><p>{p}</p><nav><p>{p} Menu.</p></nav><form><div>{p} Form.</div></form></article></body></html>"
    docs = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string").union(spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").limit(60))
    text = {r.page_id: r.text for r in html_trees.extract_pages(docs).where("url = 'u'").collect()}[1]
    assert text == f"{p} {p}"
