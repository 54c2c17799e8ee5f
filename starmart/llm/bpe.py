"""Byte-level BPE encoding and decoding through a serialised sentencepiece model.

The model is written straight from a rank file, nothing is trained: every byte
string of the vocabulary becomes a piece whose characters are its bytes moved
to U+0100..U+01FF, its score is the negative rank, and normalisation is the
identity.  sentencepiece then merges the adjacent pair of highest score first,
leftmost among equals, which is the rank order of byte-level BPE.  Texts are
split by the pre-token pattern; each distinct pre-token is encoded once per
task and its ids are kept in a bounded table (a full table is emptied and
refilled, so results never depend on it).  A pre-token that is itself in the
vocabulary takes that id.  Decoding maps ids back to pieces and characters
back to bytes.

Null and empty texts have no ids and decode to no bytes.  Repeated rows each
give a row; other columns are untouched.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import unused

SHIFT = 0x100
STOP = chr(2 * SHIFT)
CACHE_ENTRIES = 1 << 19
_loaded: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file whose lines hold a base64 token and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


def as_piece(token: bytes) -> str:
    return "".join(chr(SHIFT + b) for b in token)


def serialise(ranks: dict[bytes, int]) -> tuple[bytes, list[int]]:
    """The sentencepiece model of a rank table, and the rank of each piece."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    ordered = sorted(ranks.items(), key=lambda x: x[1])
    for token, rank in ordered:
        model.pieces.add(piece=as_piece(token), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    # a piece of its own that parts the pre-tokens of one call: it merges with nothing
    model.pieces.add(piece=STOP, score=-float(len(ordered)), type=pb.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    t, n = model.trainer_spec, model.normalizer_spec
    t.model_type, t.vocab_size, t.unk_id = pb.TrainerSpec.BPE, len(model.pieces), len(ordered) + 1
    t.bos_id = t.eos_id = t.pad_id = -1
    n.name, n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces = "identity", False, False, False
    return model.SerializeToString(), [r for _, r in ordered]


class Codec:
    """Encoder and decoder of one model in one Python worker."""

    def __init__(self, model: bytes, ranks: list[int], pattern: str):
        import regex
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        self.ranks, self.stop = np.asarray(ranks, "<u4"), len(ranks)
        pieces = [bytes(ord(c) - SHIFT for c in self.sp.id_to_piece(i)) for i in range(len(ranks))]
        self.bytes_of = dict(zip(ranks, pieces, strict=True))
        self.whole = {p: i for i, p in enumerate(pieces)}
        self.cache: dict[str, bytes] = {}

    def fill(self, tokens: list[str]) -> None:
        if len(self.cache) + len(tokens) > CACHE_ENTRIES:
            self.cache.clear()
        raw = [t.encode() for t in tokens]
        rest = [i for i, r in enumerate(raw) if r not in self.whole]
        for t, r in zip(tokens, raw, strict=True):
            if r in self.whole:
                self.cache[t] = self.ranks[self.whole[r]].tobytes()
        for lo in range(0, len(rest), 4096):
            part = rest[lo:lo + 4096]
            joined = b"\xff\xff\xff".join([raw[i] for i in part])  # no UTF-8 text holds these bytes
            pieces = joined.decode("latin-1").translate(_TO_PIECE).replace(_PARTED, STOP)
            ids = np.asarray(self.sp.encode(pieces, num_threads=1), np.int64)
            stops = np.flatnonzero(ids == self.stop)
            data, starts = self.ranks[np.where(ids == self.stop, 0, ids)].tobytes(), [0, *(4 * stops + 4).tolist()]
            for i, a, b in zip(part, starts, [*(4 * stops).tolist(), 4 * len(ids)], strict=True):
                self.cache[tokens[i]] = data[a:b]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        tokens = self.split(text)
        known = list(map(self.cache.get, tokens))
        if None in known:
            new = {t for t, k in zip(tokens, known, strict=True) if k is None}
            if len(self.cache) + len(new) > CACHE_ENTRIES:
                new = set(tokens)
            self.fill(list(new))
            known = map(self.cache.__getitem__, tokens)
        return b"".join(known)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_TO_PIECE = {b: SHIFT + b for b in range(256)}
_PARTED = 3 * chr(SHIFT + 0xFF)


def _codec(shared) -> Codec:
    """One codec per worker process and model."""
    model, ranks, pattern, name = shared.value
    if name not in _loaded:
        _loaded[name] = Codec(model, ranks, pattern)
    return _loaded[name]


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` replaced by ``ids`` (binary, little-endian unsigned
    32-bit) and ``decoded`` (the bytes those ids stand for).  The model is
    broadcast; its size is that of the vocabulary file, whatever the data."""
    import xxhash

    model, ranks = serialise(read_ranks(vocabulary))
    shared = docs.sparkSession.sparkContext.broadcast(
        (model, ranks, pattern, xxhash.xxh3_64_hexdigest(model + pattern.encode())))
    keep = [c for c in docs.columns if c not in (text, "ids", "decoded")]
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias(unused(keep, "_text")))
    schema = T.StructType([*source.select(*[f"`{c}`" for c in keep]).schema.fields,
                           T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                ids = [codec.encode(t) if t else b"" for t in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(ids, pa.binary()),
                     pa.array([codec.decode(x) for x in ids], pa.binary())],
                    names=[*keep, "ids", "decoded"])

    return source.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the bytes of the column of ids (null: none)."""
    model, ranks = serialise(read_ranks(vocabulary))
    shared = df.sparkSession.sparkContext.broadcast((model, ranks, ".", f"decode-{vocabulary}"))
    schema = T.StructType([*df.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            out = [codec.decode(x or b"") for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             names=[*batch.schema.names, "decoded"])

    return df.mapInArrow(run, schema)
