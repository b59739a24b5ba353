"""BPE encoding and decoding of documents (backtracking encoder, offset
table; see ``wordbpe``).

Both are narrow: no shuffle, one Arrow batch in memory, nothing to the
driver.  Ids travel as one binary value of little-endian unsigned 32-bit
integers for each document.

Defined results.  Null text: the empty text (no ids, empty decoded
text).  Very long texts are encoded whole; a single word of any length
takes linear time.  Special tokens in a text get their own ids.  Rows
are independent: repeated rows give repeated results, an empty table an
empty one, columns other than the id and the text are not read.  A null
id stays null.
"""

from __future__ import annotations

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import id_and_text, map_batches
from ledgerline.llm.wordbpe import word_bpe

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every whole text."""
    path = path or tokenizer_path()

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = word_bpe(path)
        ids = [encoder.encode(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return map_batches(id_and_text(docs, id_col, text_col), encode, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, text): the decoded text beside the ids."""
    path = path or tokenizer_path()

    def decode(batch: pa.RecordBatch) -> pa.RecordBatch:
        decoder = word_bpe(path)
        texts = [decoder.decode(i).decode("utf-8") for i in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())],
                                          ["doc_id", "ids", "text"])

    return map_batches(encoded.select("doc_id", "ids"), decode, "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, text) by both operators in one pass."""
    path = path or tokenizer_path()

    def both(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = word_bpe(path)
        ids = [coder.encode(t) for t in batch.column("text").to_pylist()]
        texts = [coder.decode(i).decode("utf-8") for i in ids]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary()),
                                           pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return map_batches(id_and_text(docs), both, "doc_id long, ids binary, text string")


def bpe_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Number of ids, and SHA-256 of the ids and of the decoded text."""
    return round_trip(docs, path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
