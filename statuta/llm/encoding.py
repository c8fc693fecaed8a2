"""Encoding of a corpus with a public byte-level BPE vocabulary.

Each executor process loads the rank file once (the path is a parameter) and
encodes whole Arrow batches.  Long texts are cut at positions where the
vocabulary's pre-tokenization pattern always has a token boundary, so memory
stays bounded and the ids equal those of the uncut text.

Defined results: a null text and an empty text give an empty list; strings of
special tokens are ordinary text; bytes that are not valid UTF-8 are encoded
as raw bytes.  Repeated ids give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statuta.session import spread

#: Where the vocabulary files lie unless the caller names another folder.
TOKENIZER_DIR = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"

# Fixed value: the pre-tokenization pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Texts of more code points than this are cut before encoding.
LONG_TEXT = 16_384

# A token always ends here: before a lone space between visible characters,
# and where letters turn into digits or signs, or digits into letters or signs.
_SAFE = regex.compile(r"(?<=\S)(?= \S)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])")


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> tiktoken.Encoding:
    """The encoding of the rank file at ``path``, one per process."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("statuta", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, size: int = LONG_TEXT) -> Iterator[str]:
    """Cut ``text`` at safe boundaries into parts of about ``size`` characters.

    A part grows beyond ``size`` only while the text has no safe boundary.
    """
    start = 0
    while len(text) - start > size:
        found = _SAFE.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode_bytes(raw: bytes | None, encoding: tiktoken.Encoding, size: int = LONG_TEXT) -> list[int]:
    """Ids of one stored text, given as its bytes."""
    if not raw:
        return []
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return encoding._encode_bytes(raw)
    if len(text) <= size:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    for part in safe_parts(text, size):
        ids.extend(encoding.encode_ordinary(part))
    return ids


def decode_ids(ids: Iterable[int], encoding: tiktoken.Encoding) -> str:
    """Text of ``ids``: the tokens' raw bytes joined first, decoded afterwards."""
    return encoding.decode_bytes(list(ids)).decode("utf-8", errors="replace")


def encode_corpus(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_dir: str = TOKENIZER_DIR,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """One row (``id_col``, ids ARRAY<INT>) for each row of ``docs``."""
    path = f"{tokenizer_dir}/{vocabulary}"
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(path)
        for batch in batches:
            ids = [encode_bytes(raw, encoding) for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("raw"))
    return spread(rows, id_col).mapInArrow(run, schema)


def decode_column(ids: Column, tokenizer_dir: str = TOKENIZER_DIR, vocabulary: str = VOCABULARY) -> Column:
    """Column expression that turns a column of id lists back into text."""
    path = f"{tokenizer_dir}/{vocabulary}"

    @F.pandas_udf("string")
    def run(series):  # noqa: ANN001
        import pandas as pd

        encoding = encoder(path)
        return pd.Series([None if x is None else decode_ids(x.tolist(), encoding) for x in series], dtype=object)

    run.__annotations__.clear()
    return run(ids)
