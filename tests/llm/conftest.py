import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_texts():
    """Texts that operators must take: empty, null, long, tied, odd characters."""
    return [
        "",
        None,
        " \n\t ",
        "one",
        "Thin, thin. THIN thin,. ...",
        "a" * 5000,
        "É É Éa ß ﬁ Σς İI ſ K",
        "zero\x1cwidth​ \x85 \xa0   end\x0bvt\x0cff",
        "<|endoftext|> and <|startoftext|>x it's I'LL 12½",
        "words and more words, " * 3000,
        "中文 字符 क़ 가나 \U0001f600\U0001f600",
        "one",
    ]


@pytest.fixture()
def odd_docs(spark, odd_texts):
    rows = [(i, t, "x", i) for i, t in enumerate(odd_texts)] + [(None, "null key here", None, None), (3, "same key", "y", 1), (3, "same key", "y", 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, part bigint")


def table(name, sf=SF):
    return pd.read_parquet(f"{sf}/{name}.parquet")
