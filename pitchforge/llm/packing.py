"""Best-fit packing of token sequences (operator 5).

Whole documents are tokenised, an end id is appended, and only documents
longer than a sequence are cut: full-length pieces last, a shorter rest first.
Pieces are dealt by hash to shards of about ``SHARD_TOKENS`` tokens; each shard
is packed by online best fit with a fixed number of open bins, its stream
running from long to short pieces, which leaves about 0.1 % of space unused
(2 % in order of arrival).  The open bins are kept in a bitset keyed by free space, so the best fit for a piece is the
lowest set bit at or above its length.  When all bins are open and none fits,
the fullest one closes.

Null text counts as empty (one piece that holds the end id alone); repeated
ids and rows are packed as rows of their own; a null id stays null; an empty
table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, narrow, with_row_id
from .tokens import encoder

SEQUENCE = 2048
#: Tokens in a shard on average: 1024 sequences, so a shard's last open bins cost little.
SHARD_TOKENS = 1024 * SEQUENCE
#: Bins that a shard keeps open.
OPEN_BINS = 1024


def tokenize_pieces(docs: DataFrame, vocabulary: str, end_id: int = 0, sequence: int = SEQUENCE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (rid, doc_id, piece, start, length, ids_crc32): one for each piece."""
    src = with_row_id(narrow(docs, doc_id=id_col, text=text_col))

    @F.pandas_udf("array<struct<piece: int, start: long, length: long, ids_crc32: long>>")
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc, end = encoder(vocabulary), end_id.to_bytes(4, "little")
        for texts in batches:
            out = []
            for text in texts:
                ids, cut = enc.encode(text) + end, []
                at, n = 0, len(ids) // 4
                while at < n:
                    size = (n - at) % sequence or sequence
                    crc = zlib.crc32(ids[4 * at:4 * (at + size)])
                    cut.append({"piece": len(cut), "start": at, "length": size, "ids_crc32": crc})
                    at += size
                out.append(cut)
            yield pd.Series(out, dtype=object)

    return src.select("rid", "doc_id", F.inline(pieces("text")))


def best_fit(lengths, capacity: int = SEQUENCE, open_bins: int = OPEN_BINS):
    """Online bounded-space best fit: (bin, offset) for each length, in order."""
    free_sets: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free space
    mask = opened = used = 0  # bit f is set if a bin with f free is open
    out = []
    for need in lengths:
        fits = mask >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            at = free_sets[free].pop()
            if not free_sets[free]:
                mask ^= 1 << free
            opened -= 1
        else:
            if opened >= open_bins:
                fullest = (mask & -mask).bit_length() - 1
                free_sets[fullest].pop()
                if not free_sets[fullest]:
                    mask ^= 1 << fullest
                opened -= 1
            at, free, used = used, capacity, used + 1
        out.append((at, capacity - free))
        left = free - need
        if left:
            free_sets[left].append(at)
            mask |= 1 << left
            opened += 1
    return out


def pack_pieces(pieces: DataFrame, sequence: int = SEQUENCE, open_bins: int = OPEN_BINS,
                shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Adds (sequence_id, offset) to rows of ``tokenize_pieces``.

    ``pieces`` has to be a written table: it is read twice.  A piece holds a
    token at least, so a shard's rows are bounded by its tokens.
    """
    total = pieces.agg(F.sum("length")).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "rid", "piece"], ascending=[False, True, True], kind="stable")
        placed = best_fit(pdf["length"].tolist(), sequence, open_bins)
        base = int(pdf["shard"].iloc[0]) << 40
        return pdf.assign(sequence_id=[base + b for b, _ in placed], offset=[o for _, o in placed]).drop(columns="shard")

    # pandas has no exact long that may be null, so ids go through it as text
    kind = pieces.schema["doc_id"].dataType
    dealt = pieces.withColumn("doc_id", F.col("doc_id").cast("string")).withColumn(
        "shard", F.pmod(F.xxhash64("rid", "piece"), F.lit(shards)))
    schema = ("rid long, doc_id string, piece int, start long, length long, ids_crc32 long, "
              "sequence_id long, offset long")
    return dealt.groupBy("shard").applyInPandas(pack, schema).withColumn("doc_id", F.col("doc_id").cast(kind))


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 0, sequence: int = SEQUENCE,
                   open_bins: int = OPEN_BINS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece, with its place: see the module's text."""
    pieces = materialize(tokenize_pieces(docs, vocabulary, end_id, sequence, id_col, text_col), "pieces")
    return pack_pieces(pieces, sequence, open_bins).drop("rid")
