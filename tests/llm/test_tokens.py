from __future__ import annotations

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from rideflow.llm import tokens

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
WHOLE = sentencepiece.SentencePieceProcessor(model_file=MODEL)
with open(MODEL, "rb") as file:
    SMALL = tokens.Tokens(file.read(), chunk=40, overlap=6)

TEXTS = [
    "", " ", "  ", "a", "x " * 500, " " * 500, "nospacesatall" * 60, "漢字かな" * 80, "a▁b ▁ c " * 60, "é\U0001F600 z " * 70, "\n\t\r\n " * 90,
    "word " * 9 + "x" * 300 + " word" * 20, "</s><s> <unk> <0x41> " * 30, "a  b   c    d " * 50, "漢 " * 100, "tail space " * 20 + "   ",
]


@pytest.mark.parametrize("text", TEXTS)
def test_spliced_equals_whole(text):
    assert SMALL.spaces_part
    assert SMALL.count([text, "ab", text]) == [len(WHOLE.encode(t)) for t in (text, "ab", text)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab .é漢\n▁\U0001F600,A", min_size=41, max_size=400))
def test_any_text(text):
    assert SMALL.spliced(text) == len(WHOLE.encode(text))


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = tokens.token_report(docs, MODEL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(WHOLE.encode(texts[r.doc_id] or ""))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 4096)


def test_nulls_repeats_clashes_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (None, "a b", 5), (None, "a b", 5)], "doc_id long, text string, N_Tokens int")
    rows = tokens.counted(df, MODEL).collect()
    assert sorted((r["N_Tokens"], r["n_tokens_"]) for r in rows) == [(5, 0), (5, 2), (5, 2)]
    assert tokens.token_report(df.limit(0), MODEL).count() == 0
