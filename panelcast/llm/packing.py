"""Packing of token sequences by vector bin packing.

An example is a vector of tokens, segments and loss-bearing tokens, each against a limit of a sequence.
Sequences are filled one at a time: of the examples that fit, the one whose vector has the largest dot
product with what is left of the limits goes in, so the scarcest room is matched by the examples that
need it most. Where examples may be cut, one that does not fit fills what is left of the token limit and
its rest stays in line; full sequences are cut off long examples beforehand.

Examples are packed in blocks, the batches of a partition, so a block's work is bounded and blocks need
no shuffle. What a block cannot fill it cuts at powers of two, which need no padding.
"""

from __future__ import annotations

import base64
import json
import os
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame

from panelcast.llm.common import lean, reading, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH, SEGMENTS = 2048, 256
END = 1
CHUNK = 8_000_000
VOCABULARY = "byte_bpe_50k.tiktoken"


class Encoder:
    """Ids as ``tokenizers`` gives them with ``add_special_tokens=False``: an added token in a text is one
    id, and what stands around it is encoded by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, added: dict[str, int]):
        import tiktoken

        self.inner = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

    def encode_ordinary(self, text: str) -> list[int]:
        return self.inner.encode(text, allowed_special="all")

    def encode_to_numpy(self, text: str) -> np.ndarray:
        return self.inner.encode_to_numpy(text, allowed_special="all")


def added_tokens(path: str) -> dict[str, int]:
    """Added tokens and their ids in a ``tokenizers`` file, if there is one."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as file:
        listed = json.load(file)["added_tokens"]
    if odd := [x["content"] for x in listed if x["single_word"] or x["lstrip"] or x["rstrip"]]:
        raise ValueError(f"added tokens that take in or depend on their surroundings: {odd}")
    return {x["content"]: x["id"] for x in listed}


def encoding(vocabulary: str | None = None) -> Encoder:
    """The byte-level BPE over the ranks in ``vocabulary`` (a path, by default that of the installed
    file), with the added tokens of the ``.json`` file beside it; its ids are those of that file."""
    import public_tokenizers

    vocabulary = str(vocabulary or public_tokenizers.path(VOCABULARY))
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return Encoder(ranks, public_tokenizers.PATTERN, added_tokens(os.path.splitext(vocabulary)[0] + ".json"))


def fill(vectors: np.ndarray, limits: np.ndarray, cut: bool = False) -> list[list[tuple[int, int, int]]]:
    """Bins of ``(example, start, length)`` for rows of ``tokens, segments, loss-bearing tokens``.

    With ``cut`` the tokens may be divided anywhere, the loss-bearing ones of a rest being bounded by its
    length. An example that exceeds a limit by itself gets a bin of its own.
    """
    need = np.asarray(vectors, np.float64).reshape(-1, len(limits)).copy()
    limits = np.asarray(limits, np.float64)
    start, bins = np.zeros(len(need), np.int64), []
    todo = np.arange(len(need))
    while len(todo):
        room, content = limits.copy(), []
        while len(todo):
            inside = (need[todo] <= room).all(axis=1)
            if inside.any():
                fits = todo[inside]
                best = fits[np.argmax((need[fits] / limits) @ (room / limits))]
                part = int(need[best, 0])
            elif cut and room[0] >= 1 and room[1] >= 1 and room[2] >= 1:
                best = todo[np.argmax((need[todo] / limits) @ (room / limits))]
                part = int(min(room[0], room[2], need[best, 0]))
            elif not content:
                best = todo[0]
                part = int(need[best, 0])
            else:
                break
            content.append((int(best), int(start[best]), part))
            if part == need[best, 0]:
                room = np.maximum(room - need[best], 0)
                todo = todo[todo != best]
            else:
                start[best] += part
                room -= [part, 1, min(part, need[best, 2])]
                need[best, 0] -= part
                need[best, 2] = min(need[best, 2], need[best, 0])
            if room[0] == 0 and (need[todo, 0] > 0).all():
                break
        bins.append(content)
    return bins


def at_powers(content: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """A bin's pieces divided to sequences whose lengths are powers of two, the longest first."""
    left = sum(n for _, _, n in content)
    pieces = list(reversed(content))
    while left:
        size = room = 1 << (left.bit_length() - 1)
        out = []
        while room:
            example, start, n = pieces.pop()
            take = min(n, room)
            out.append((example, start, take))
            if take < n:
                pieces.append((example, start + take, n - take))
            room -= take
        left -= size
        yield out


def pack(
    tokens: list[np.ndarray], length: int = LENGTH, segments: int = SEGMENTS, loss: int | None = None
) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(example, start, length)`` covering every token of every example once. Of a
    document's tokens all but the first bear loss; a sequence has at most ``loss`` such tokens (by default
    ``length``, which never binds)."""
    loss = length if loss is None else loss
    if loss < 1:
        raise ValueError("a sequence needs room for one loss-bearing token")
    sequences, rest = [], []
    for i, ids in enumerate(tokens):
        whole = len(ids) // length * length if loss >= length else 0
        sequences += [[(i, at, length)] for at in range(0, whole, length)]
        if len(ids) > whole:
            rest.append((i, whole, len(ids) - whole))
    vectors = np.array([[n, 1, n if at else n - 1] for _, at, n in rest], np.float64)
    for content in fill(vectors, np.array([length, segments, loss]), cut=True):
        content = [(rest[k][0], rest[k][1] + at, n) for k, at, n in content]
        if sum(n for _, _, n in content) == length:
            sequences.append(content)
        else:
            sequences += at_powers(content)
    return sequences


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    start, size = 0, 0
    for i, x in enumerate(texts):
        size += len(x or "")
        if size >= CHUNK:
            yield start, [y or "" for y in texts[start : i + 1]]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, [y or "" for y in texts[start:]]


def pack_batches(fields: list[str], vocabulary: str | None, length: int, segments: int, loss: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sequence = encoding(vocabulary), TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, texts in chunks(batch["text"].to_pylist()):
                tokens = [np.append(encoder.encode_to_numpy(x), np.uint32(END)).astype("<u4") for x in texts]
                sequences = pack(tokens, length, segments, loss)
                pieces = [(s, i, at, n) for s, content in enumerate(sequences) for i, at, n in content]
                number, doc, at, n = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
                ends = np.cumsum(n)
                fresh = np.concatenate([[True], number[1:] != number[:-1]])
                begin = np.maximum.accumulate(np.where(fresh, ends - n, 0))
                crc = [zlib.crc32(tokens[i][a : a + k].tobytes()) for _, i, a, k in pieces]
                rows = {f: batch[f].take(pa.array(doc + first)) for f in fields}
                rows |= {
                    "start": at,
                    "length": n,
                    "ids_crc32": np.array(crc, np.int64),
                    "doc_tokens": np.fromiter(map(len, tokens), np.int64, len(tokens))[doc],
                    "sequence_id": number + sequence,
                    "offset": ends - n - begin,
                }
                sequence += len(sequences)
                yield pa.RecordBatch.from_pydict({k: pa.array(v) if isinstance(v, np.ndarray) else v for k, v in rows.items()})

    return lean(run)


def pack_documents(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    length: int = LENGTH,
    segments: int = SEGMENTS,
    loss: int | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its ids, an added token of the vocabulary being one of them, and the id 1; a null text
    is only that id. Every id lies in one piece; a sequence has at most ``length`` ids, ``segments`` pieces and
    ``loss`` loss-bearing ids (all but a document's first; by default not bounded), and is full or has a
    power of two of ids. Sequence ids are unique, not consecutive: partition and number
    within it. Repeated rows are packed as often; an empty table gives an empty result.
    """
    small_batches(df.sparkSession)
    rows = reading(df, doc_id=doc_id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(pack_batches(["doc_id"], vocabulary, length, segments, loss), schema)
