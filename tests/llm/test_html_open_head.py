"""Pages whose </head> is left out keep their text."""

import pytest

from furrow.llm import html_extract

BODY = "<article><h1>Title here</h1><p>One two three four five six seven eight nine ten.<p>Next one here, with more words.</article>"


@pytest.mark.parametrize("start", ["<html><head><title>x</title><meta charset=utf-8><body>", "<head><title>x</title><style>a{}</style>", "<head>\n<link href=a><head><title>x</title>", "<head><title>x</title></head><body>"])
def test_an_open_head_ends_where_the_body_begins(spark, start):
    df = spark.createDataFrame([(1, "u", start + BODY)], "page_id long, url string, html string")
    assert html_extract.extract(df).first().text == "Title here One two three four five six seven eight nine ten. Next one here, with more words."


def test_text_ends_an_open_head(spark):
    words = "Plain words stand here and go on for long enough, one after the other."
    df = spark.createDataFrame([(1, "u", "<head><meta charset=utf-8>" + words)], "page_id long, url string, html string")
    assert html_extract.extract(df).first().text == words
