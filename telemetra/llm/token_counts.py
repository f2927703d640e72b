"""Token counts by counting each distinct pre-token once.

A sentencepiece BPE never merges across a place where white space begins after
other text, or before a line end, unless its vocabulary holds a piece across
such a place (this is checked).  Texts are cut there into pre-tokens.  One pass
finds the frequent pre-tokens; their counts are broadcast.  All others travel
as (pre-token, row, frequency): the shuffle by pre-token joins the frequencies
of all rows with the one count of each distinct pre-token.  Counts times
frequencies are summed per row; no ids are kept and texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum
from .heads import BYTES, SIZE, frequent

MARK = "▁"
_MARK = MARK.encode()
CHUNK_BYTES = 2 << 20


def processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_model(model: bytes) -> None:
    """Fail unless pre-tokens can be counted apart under this model."""
    sp = processor(model)
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        rest = piece.lstrip(MARK)
        if MARK in rest or (len(piece) > 1 and "\n" in piece):
            raise ValueError(f"the piece {piece!r} crosses pre-tokens")
    if "".join(sp.encode(" a  b ", out_type=str)) != f"{MARK}{MARK}a{MARK}{MARK}b{MARK}" or sp.encode(""):
        raise ValueError("the model does not keep white space as it is behind one leading space")


def pre_tokens(chunk: textnum.Chunk) -> tuple[pa.Array, np.ndarray]:
    """(pre-tokens, their documents): the texts, each behind one space as the
    model reads it, cut before every line end and every run of spaces.  A text
    without a character has none."""
    used = np.flatnonzero(np.diff(chunk.offsets))
    first = chunk.offsets[used] + np.arange(len(used))
    data = np.insert(chunk.data, chunk.offsets[used], 32)
    space = data == 32
    for k in np.flatnonzero((data[:-2] == _MARK[0]) & (data[1:-1] == _MARK[1]) & (data[2:] == _MARK[2])):
        space[k : k + 3] = True
    start = (data == 10) | space
    start[1:] &= ~(space[1:] & space[:-1])
    start[first] = True
    at = np.flatnonzero(start)
    doc = used[np.searchsorted(first, at, side="right") - 1]
    offsets = np.append(at, len(data)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary()), doc


def frequencies(chunk: textnum.Chunk) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct pre-tokens, document, pre-token, times) of a chunk."""
    tokens, doc = pre_tokens(chunk)
    coded = tokens.dictionary_encode()
    n = max(1, len(coded.dictionary))
    pairs, times = np.unique(doc * n + coded.indices.to_numpy(), return_counts=True)
    return coded.dictionary, pairs // n, pairs % n, times


def count_pieces(sp, tokens: pa.Array) -> np.ndarray:
    """The pieces that each pre-token adds to a text."""
    texts = [t.decode() for t in tokens.to_pylist()]
    out = np.ones(len(texts), np.int64)
    # the model puts a space before what it gets: at a line end it is one piece too many,
    # elsewhere it stands for the first character of the pre-token
    line = np.array([t[0] == "\n" for t in texts], bool)
    rest = [k for k, t in enumerate(texts) if line[k] or len(t) > 1]
    out[rest] = [len(ids) for ids in sp.encode([texts[k] if line[k] else texts[k][1:] for k in rest], num_threads=1)]
    return out - line


def token_counts(docs: DataFrame, model: bytes, limit: int = 4096, head_size: int = SIZE, head_bytes: int = BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs`` (doc_id, text).

    ``n_tokens`` is what the sentencepiece ``model`` gives for the whole text,
    without begin and end tokens; ``over_limit``: more than ``limit``.  NULL and
    empty texts have no bytes and no tokens.  Repeated rows are counted one by
    one, a NULL doc_id is kept, an empty table gives no rows and other columns
    are not read.  The bounds of the head change no count.
    """
    check_model(model)
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))

    def held(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
        for chunk in textnum.chunks(batch.column(0), CHUNK_BYTES):
            tokens, _, token, _ = frequencies(chunk)
            yield tokens, np.bincount(token, minlength=len(tokens))

    vocabulary = sc.broadcast(model)

    def counted(batches):
        sp = processor(vocabulary.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(count_pieces(sp, b.column(0)))], names=["key", "pieces"])

    head = frequent(docs.select("text"), held, head_size, head_bytes).select("key").mapInArrow(counted, "key binary, pieces long")
    known = head.toArrow()  # head_size rows and head_bytes bytes at most
    known = sc.broadcast((known["key"].combine_chunks(), known["pieces"].to_numpy()))
    fields = "row long, doc_id long, n_bytes long, n_tokens long, token binary, times int"
    names = [f.split()[0] for f in fields.split(", ")]

    def dealt(batches):
        """A line for each row with the tokens of its frequent pre-tokens, and one for each of its others."""
        keys, pieces = known.value
        for b in batches:
            for c in textnum.chunks(b.column(1), CHUNK_BYTES):
                tokens, doc, token, times = frequencies(c)
                place = pc.index_in(tokens, value_set=keys)
                common = pc.is_valid(place).to_numpy(zero_copy_only=False)
                each = np.zeros(len(tokens), np.int64)
                each[common] = pieces[place.drop_null().to_numpy()]
                sums = np.bincount(doc, weights=each[token] * times, minlength=c.n).astype(np.int64)
                own = b.slice(c.first, c.n)
                none = pa.nulls
                yield pa.RecordBatch.from_arrays([own.column(2), own.column(0), pa.array(np.diff(c.offsets)), pa.array(sums), none(c.n, pa.binary()), none(c.n, pa.int32())], names=names)
                rare = np.flatnonzero(~common[token])
                n = len(rare)
                for i in range(0, n, 10_000):
                    part = rare[i : i + 10_000]
                    m, row = len(part), own.column(2).take(pa.array(doc[part]))
                    yield pa.RecordBatch.from_arrays([row, none(m, pa.int64()), none(m, pa.int64()), none(m, pa.int64()), tokens.take(pa.array(token[part])), pa.array(times[part], pa.int32())], names=names)

    def joined(batches):
        """Lines come sorted by token: each distinct one is counted once."""
        sp, last, last_pieces = processor(vocabulary.value), None, 0
        for b in batches:
            rare = b.column(4).is_valid()
            yield b.filter(pc.invert(rare)).select(names[:4])
            part = b.filter(rare)
            if not part.num_rows:
                continue
            coded = part.column(4).dictionary_encode()
            tokens = coded.dictionary
            known_first = last is not None and tokens[0].as_py() == last
            each = np.concatenate([[last_pieces] if known_first else [], count_pieces(sp, tokens.slice(int(known_first)))]).astype(np.int64)
            last, last_pieces = tokens[len(tokens) - 1].as_py(), int(each[-1])
            row, place = np.unique(part.column(0).to_numpy(), return_inverse=True)
            sums = np.bincount(place, weights=each[coded.indices.to_numpy()] * part.column(5).to_numpy()).astype(np.int64)
            none = pa.nulls(len(row), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(row), none, none, pa.array(sums)], names=names[:4])

    lines = rows.mapInArrow(dealt, fields)
    # rows' own lines are spread by row, the others meet their pre-token
    lines = lines.repartition("token", F.when(F.col("token").isNull(), F.col("row"))).sortWithinPartitions("token")
    parts = lines.mapInArrow(joined, "row long, doc_id long, n_bytes long, n_tokens long")
    out = parts.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
