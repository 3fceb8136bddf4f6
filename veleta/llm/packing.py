"""Packing by power-of-two decomposition: every document is cut into pieces whose lengths are powers
of two, and pieces of one length form a bucket; a sequence is one piece, so none crosses documents
and none is padded.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from veleta.llm.common import arrow_map, raw_texts

# How this vocabulary cuts a text before merging (fixed by the vocabulary).
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(path: str):
    """text -> ids for a byte-level vocabulary file of ``tokenizers``.

    The file's vocabulary drives the byte-pair merges of ``tiktoken``, which gives the same ids in
    a quarter of the time; strings of special tokens in a text are ordinary text.
    """
    import tiktoken
    from tokenizers import Tokenizer

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=False)
    ranks = {bytes(byte[c] for c in token): rank for token, rank in vocabulary.items()
             if not token.startswith("<|")}
    return tiktoken.Encoding("file", pat_str=PIECES, mergeable_ranks=ranks,
                             special_tokens={}).encode_ordinary


@lru_cache(maxsize=2)
def file_encoder(path: str):
    """text -> ids as ``tokenizers`` gives them for the file with ``add_special_tokens=False``: the
    file's added tokens are cut out of a text first and are one id each, the rest is ``encoder``'s.
    """
    from tokenizers import Tokenizer

    whole, plain = Tokenizer.from_file(path), encoder(path)
    tokens = whole.get_added_tokens_decoder()
    if any(t.single_word or t.lstrip or t.rstrip for t in tokens.values()):
        return lambda text: whole.encode(text, add_special_tokens=False).ids
    added = {t.content: i for i, t in tokens.items()}
    if not added:
        return plain
    cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

    def encode(text: str) -> list[int]:
        first, *rest = cut.split(text)
        ids = plain(first)
        for token, part in zip(rest[::2], rest[1::2]):
            ids.append(added[token])
            ids += plain(part)
        return ids

    return encode


def binary_lengths(total: int, longest: int) -> list[int]:
    """``total`` as full pieces of ``longest`` (a power of two) and then falling powers of two."""
    rest = total % longest
    return [longest] * (total // longest) + [1 << k for k in range(rest.bit_length() - 1, -1, -1)
                                             if rest >> k & 1]


def pack(docs: DataFrame, tokenizer: str, longest: int = 1024, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket
    (log2 of the length) and, with ``keep_ids``, the token ids.

    ``tokenizer`` is the path of a vocabulary file that every executor can open.  A document is its
    ids (those of ``file_encoder``) followed by ``end_id``; null and empty texts are that id alone.  Pieces follow each other,
    so every id lies in exactly one.  Nothing is shuffled: a task numbers its own pieces, and a
    task that is run again reads the same split and gives the same numbers.  Repeated rows are
    packed once each; an empty table gives no piece; other columns are ignored.
    """
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def cut(batches):
        encode = file_encoder(tokenizer)
        for b in batches:
            who, start, length, crc, whole, ids = [], [], [], [], [], []
            for row, text in enumerate(raw_texts(b.column("text"))):
                tokens = encode(text.decode("utf-8", "replace"))
                tokens.append(end_id)
                tokens = np.array(tokens, dtype="<u4")
                at = 0
                for n in binary_lengths(len(tokens), longest):
                    piece = tokens[at:at + n]
                    who.append(row)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(piece))
                    whole.append(len(tokens))
                    if keep_ids:
                        ids.append(piece)
                    at += n
            columns = [b.column("id").take(pa.array(who, pa.int32())),
                       *(pa.array(x, pa.int64()) for x in (start, length, crc, whole))]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = arrow_map(rows, cut, schema + (", ids array<long>" if keep_ids else ""))
    return pieces.select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.log2("length").cast("int").alias("bucket"), *(["ids"] if keep_ids else []))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder per length, so a training job reads batches of equally long sequences."""
    pieces.write.partitionBy("bucket").mode("overwrite").parquet(path)
