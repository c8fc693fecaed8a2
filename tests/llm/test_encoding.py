import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statuta.llm import encoding as E

pytestmark = pytest.mark.skipif(not os.path.isdir(E.TOKENIZER_DIR), reason="no vocabulary files here")
PATH = f"{E.TOKENIZER_DIR}/{E.VOCABULARY}"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB가나 \n\t12.,'sre!é́😀　ー漢"), max_size=200), st.integers(1, 20))
def test_cutting_long_texts_changes_nothing(text, size):
    encoding = E.encoder(PATH)
    assert "".join(E.safe_parts(text, size)) == text
    assert E.encode_bytes(text.encode(), encoding, size) == (encoding.encode_ordinary(text) if text else [])


def test_ids_equal_those_of_the_other_library():
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(f"{E.TOKENIZER_DIR}/byte_bpe_50k.json")
    other.encode_special_tokens = True
    texts = ["제1조(목적) 이 규칙은 <|endoftext|> 'll 12³", "  a\n\n b ", "𠮷é́ﷺ"]
    assert [E.encode_bytes(t.encode(), E.encoder(PATH)) for t in texts] == [other.encode(t, add_special_tokens=False).ids for t in texts]


def test_broken_bytes_survive_a_round_trip():
    encoding = E.encoder(PATH)
    raw = b"ab\xff\xfe\xea\xb0"
    assert b"".join(encoding.decode_single_token_bytes(i) for i in E.encode_bytes(raw, encoding)) == raw


def test_tables(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "가" * 50_000), (5, "x"), (5, "x"), (None, "y")]
    frame = spark.createDataFrame([(*r, [1]) for r in rows], "doc_id long, text string, ids array<int>")
    out = E.encode_corpus(frame)
    got = {(r["doc_id"], tuple(r["ids"])) for r in out.collect()}
    assert {(1, ()), (2, ())} < got and out.count() == 7
    back = {r[0]: r[1] for r in out.select("doc_id", E.decode_column(F.col("ids"))).collect()}
    assert back[4] == "가" * 50_000 and back[1] == "" and back[3] == " "


def test_empty_table(spark):
    assert E.encode_corpus(spark.createDataFrame([], "doc_id long, text string")).count() == 0
