"""Byte-level BPE by prefix dynamic programming: one last token per byte prefix.

The encoding of every prefix of a piece ends in exactly one token. Tokens ``t1 … tn`` are the encoding of
their bytes if and only if each neighbouring pair is the encoding of its own bytes (a merge across a
boundary would also happen in the pair alone). So the last token of the prefix of ``i`` bytes is the one
token ``t`` that ends there and may follow the last token of the prefix ``t`` starts from. An automaton
lists the tokens that end at each byte, verdicts on pairs are kept, and the encoding is read off backwards.

A table of last tokens makes updates exact and local. Text appended to a piece goes on from the table's
end. After an edit the table stands up to the edit, and again from where as many neighbouring entries as
the longest token has bytes agree with the old table, because later entries depend on no others.

A text is cut by the pattern into pieces, each encoded by itself; a piece that is a token as a whole is that
token. A decision about a piece looks at most two characters beyond it, so an edit is cut again
from ``CONTEXT`` pieces before it until a piece ends where an old one did.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import reading, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CONTEXT = 4
#: Pieces and verdicts a worker keeps; of pieces it keeps those of the last two spells of so many.
KEPT_PIECES, KEPT_PAIRS = 500_000, 2_000_000
#: Characters of the longest piece that is kept.
KEPT_LENGTH = 200


class Vocabulary:
    """Tokens by rank, the automaton over them, and the verdicts on pairs met so far."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks))
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.split: dict[int, list[int]] = {}

    @classmethod
    def load(cls, path: str | None = None) -> Vocabulary:
        """From a file of base64 tokens and ranks, by default the installed one for many languages."""
        import public_tokenizers

        with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def merged(self, data: bytes, least: int = 1) -> list[int]:
        """The definition: join the neighbours of least rank, the first of equal ones, until none make a token
        (or ``least`` parts are left). For the few bytes of one or two tokens."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > least:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], sys.maxsize), i) for i in range(len(parts) - 1))
            if rank == sys.maxsize:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def halves(self, token: int) -> list[int]:
        """The two tokens merged last into ``token``, none for a byte. KeyError if its merges do not come in the
        order of their ranks."""
        found = self.split.get(token)
        if found is None:
            found = self.merged(self.tokens[token], 2) if len(self.tokens[token]) > 1 else []
            if found and (len(found) != 2 or max(found) >= token):
                raise KeyError(token)
            for half in found:
                self.halves(half)
            self.split[token] = found
        return found

    def _apart(self, a: int, b: int) -> bool:
        """Whether no merge joins the end of ``a`` with the beginning of ``b``. Merges are undone from the last
        one back: what then meets at the boundary must not make a token that comes before the merge undone
        (of equal ones the merge further left is first)."""
        tokens, rank, bound = self.tokens, self.ranks.get, sys.maxsize
        while True:
            if rank(tokens[a] + tokens[b], bound) < bound:
                return False
            left, right = self.halves(a), self.halves(b)
            if left and (a > b or not right):
                a, bound = left[1], a
            elif right:
                b, bound = right[0], b + 1
            else:
                return True

    def follows(self, left: int, right: int) -> bool:
        """Whether ``right`` may stand after ``left`` (-1: at the beginning)."""
        pair = left * len(self.tokens) + right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            try:
                self.halves(right)
                known = left < 0 or self._apart(left, right)
            except KeyError:
                tokens = [right] if left < 0 else [left, right]
                known = self.merged(b"".join(self.tokens[t] for t in tokens)) == tokens
            self.pairs[pair] = known
        return known

    def steps(self, data: bytes, last: list[int]) -> Iterator[int]:
        """Extend ``last``, the last tokens of the first ``len(last) - 1`` bytes' prefixes, byte by byte."""
        for end, (token, size) in self.automaton.iter(data.decode("latin-1"), max(0, len(last) - self.longest)):
            i = end + 1
            # Exactly one token fits each prefix, so the first one found decides.
            if i == len(last) and size <= i and self.follows(last[i - size], token):
                last.append(token)
                yield i

    def last_tokens(self, data: bytes, last: list[int] | None = None) -> list[int]:
        """The last token of every prefix of ``data``; ``last`` holds those of a shorter prefix, if known.
        Entry 0 stands for the empty prefix."""
        if last:
            for _ in self.steps(data, last):
                pass
            return last
        # The same as ``steps``, with nothing around the loop.
        last, known, follows, n = [-1], self.pairs.get, self.follows, len(self.tokens)
        i = 1
        for end, (token, size) in self.automaton.iter(data.decode("latin-1")):
            if end + 1 == i:
                left = last[i - size]
                fits = known(left * n + token)
                if follows(left, token) if fits is None else fits:
                    last.append(token)
                    i += 1
        return last

    def replaced(self, old: bytes, last: list[int], new: bytes) -> tuple[list[int], int]:
        """The table of ``new`` from that of ``old``, and how many of its entries were worked out."""
        same = _common(old, new)
        tail = min(_common(old[::-1], new[::-1]), len(old) - same, len(new) - same)
        shift, kept, out, agree = len(new) - len(old), len(new) - tail, last[: same + 1], 0
        for i in self.steps(new, out):
            agree = agree + 1 if i - shift > 0 and out[i] == last[i - shift] else 0
            if agree >= self.longest and i - self.longest >= kept:
                out.extend(last[i - shift + 1 :])
                return out, i - same
        return out, len(new) - same

    def read_off(self, data: bytes, last: list[int]) -> list[int]:
        """The encoding that a table of last tokens ends in."""
        if data in self.ranks:
            return [self.ranks[data]]
        out, i = [], len(data)
        while i:
            out.append(last[i])
            i -= len(self.tokens[last[i]])
        return out[::-1]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


class Coder:
    """Whole texts: cut into pieces, each encoded by its table; short pieces met before are kept."""

    def __init__(self, vocabulary: str | None = None):
        import public_tokenizers
        import regex

        self.words, self.pattern = Vocabulary.load(vocabulary), regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def piece(self, text: str) -> bytes:
        """The ids of a piece as little-endian unsigned 32-bit integers."""
        ids = self.before.get(text)
        if ids is None:
            data = text.encode()
            whole = self.words.ranks.get(data)
            found = self.words.read_off(data, self.words.last_tokens(data)) if whole is None else [whole]
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(text) <= KEPT_LENGTH:
            if len(self.known) >= KEPT_PIECES:
                self.before, self.known = self.known, {}
            self.known[text] = ids
        return ids

    def coded(self, text: str) -> bytes:
        """The ids of a text, like those of a piece."""
        pieces = self.pattern.findall(text)
        ids = list(map(self.known.get, pieces))
        if None in ids:
            ids = [self.known.get(p) or self.piece(p) if x is None else x for x, p in zip(ids, pieces, strict=True)]
        return b"".join(ids)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.coded(text), "<u4").tolist()


class Stored:
    """A text with its pieces and their tables."""

    def __init__(self, coder: Coder, pieces: list[str], tables: list[list[int]]):
        self.coder, self.pieces, self.tables = coder, pieces, tables

    @classmethod
    def of_text(cls, coder: Coder, text: str) -> Stored:
        pieces = coder.pattern.findall(text)
        return cls(coder, pieces, [coder.words.last_tokens(p.encode()) for p in pieces])

    @classmethod
    def of_columns(cls, coder: Coder, text: str, lengths: list[int], last: np.ndarray) -> Stored:
        """From what ``columns`` gives: characters of each piece, and the tables without their first entries."""
        pieces, tables, at, byte = [], [], 0, 0
        for n in lengths:
            pieces.append(text[at : at + n])
            size = len(pieces[-1].encode())
            tables.append([-1, *last[byte : byte + size].tolist()])
            at, byte = at + n, byte + size
        return cls(coder, pieces, tables)

    def columns(self) -> tuple[str, list[int], list[int]]:
        return self.text, [len(p) for p in self.pieces], list(chain.from_iterable(t[1:] for t in self.tables))

    @property
    def text(self) -> str:
        return "".join(self.pieces)

    def ids(self) -> list[int]:
        read_off = self.coder.words.read_off
        return list(chain.from_iterable(read_off(p.encode(), t) for p, t in zip(self.pieces, self.tables, strict=True)))

    def edit(self, start: int, end: int, insertion: str) -> int:
        """Replace the characters ``[start, end)``; returns how many table entries were worked out. Positions
        beyond the text count as its end, an end before the start as the start."""
        text, coder = self.text, self.coder
        start = min(max(start, 0), len(text))
        end = min(max(end, start), len(text))
        fresh, shift = text[:start] + insertion + text[end:], start + len(insertion) - end
        ends = np.cumsum([len(p) for p in self.pieces], dtype=np.int64)
        first = max(0, int(np.searchsorted(ends, start, "right")) - CONTEXT)
        at = int(ends[first - 1]) if first else 0
        old = {int(e): i for i, e in enumerate(ends[first:], first) if e >= end}
        pieces, beyond = [], len(self.pieces)
        for m in coder.pattern.finditer(fresh, at):
            pieces.append(m.group())
            if m.end() >= start + len(insertion) and m.end() - shift in old:
                beyond = old[m.end() - shift] + 1
                break
        before, tables, work = self.pieces[first:beyond], [], 0
        for i, piece in enumerate(pieces):
            # Pieces before the edit keep their place from the front, the last ones theirs from the back.
            j = i if i < len(before) and _common(before[i].encode(), piece.encode()) else len(before) - len(pieces) + i
            if 0 <= j < len(before):
                table, n = coder.words.replaced(before[j].encode(), self.tables[first + j], piece.encode())
            else:
                table, n = coder.words.last_tokens(piece.encode()), len(piece.encode())
            tables.append(table)
            work += n
        self.pieces[first:beyond], self.tables[first:beyond] = pieces, tables
        return work


# --- tables ---------------------------------------------------------------------------


def _lists(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array(values, pa.list_(kind))


def _encode(vocabulary: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(vocabulary)
        for batch in batches:
            ids = [np.frombuffer(coder.coded(x.as_py() or ""), "<i4") for x in batch["text"]]
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "ids": _lists(ids, pa.int32())})

    return run


def encode(df: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row; null and empty texts have no ids. Rows are kept as they are, whatever
    their id. ``vocabulary`` is a path that executors can read (default: the installed file)."""
    small_batches(df.sparkSession)
    rows = reading(df, doc_id=doc_id, text=text)
    return rows.mapInArrow(_encode(vocabulary), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(df: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, body``: the bytes of every row's ids (null: none). An id that is not in the vocabulary fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary.load(vocabulary)
        for batch in batches:
            bodies = [words.decode(x.as_py() or []) for x in batch["ids"]]
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "body": pa.array(bodies, pa.binary())})

    rows = reading(df, doc_id=doc_id, ids=ids)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, body binary")


def _digests(vocabulary: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(vocabulary)
        for batch in batches:
            counts, coded, decoded = [], [], []
            for x in batch["text"]:
                ids = coder.coded(x.as_py() or "")
                counts.append(len(ids) // 4)
                coded.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(coder.words.decode(np.frombuffer(ids, "<u4").tolist())).hexdigest())
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(coded, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())}
            )

    return run


def round_trip(df: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: every text encoded and decoded again in one pass, so
    neither texts nor ids are shuffled or stored."""
    small_batches(df.sparkSession)
    rows = reading(df, doc_id=doc_id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_digests(vocabulary), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _store(vocabulary: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(vocabulary)
        for batch in batches:
            found = [Stored.of_text(coder, x.as_py() or "").columns() for x in batch["text"]]
            texts, pieces, last = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], "text": pa.array(texts, pa.string()), "pieces": _lists(pieces, pa.int32()), "last": _lists(last, pa.int32())}
            )

    return run


def store(df: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, pieces, last``: characters of every piece and the last token of every byte prefix of
    its piece. A null text is stored as an empty one."""
    small_batches(df.sparkSession)
    rows = reading(df, doc_id=doc_id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_store(vocabulary), f"doc_id {kind}, text string, pieces array<int>, last array<int>")


def _edit(vocabulary: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(vocabulary)
        for batch in batches:
            out = {k: [] for k in ("text", "pieces", "last", "ids", "worked")}
            for text, pieces, last, edits in zip(*(batch[c] for c in ("text", "pieces", "last", "edits")), strict=True):
                held = Stored.of_columns(coder, text.as_py(), pieces.as_py(), last.values.to_numpy(zero_copy_only=False))
                work = sum(held.edit(e["start"], e["end"], e["insertion"] or "") for e in edits.as_py() or [])
                for column, value in zip(out.values(), (*held.columns(), held.ids(), work), strict=True):
                    column.append(value)
            kinds = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64())
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"]} | {k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds, strict=True)})

    return run


def apply_edits(stored: DataFrame, edits: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Stored rows after their edits: ``doc_id, text, pieces, last, ids, worked`` (table entries worked out).

    ``edits`` holds a row per edit, ``doc_id, seq, start, end, insertion``: the characters ``[start, end)`` of
    the text that the edits of smaller ``seq`` left are replaced (ties: by start, end, insertion; an append
    starts at or beyond the end). Edits with a null position are skipped, a null insertion is empty, an id
    without stored text is ignored. Rows without edits stay as they are; rows under one id are edited alike.
    """
    small_batches(stored.sparkSession)
    each = F.struct("seq", "start", "end", F.coalesce("insertion", F.lit("")).alias("insertion"))
    wanted = edits.filter("doc_id is not null and start is not null and end is not null").groupBy("doc_id").agg(F.sort_array(F.collect_list(each)).alias("edits"))
    rows = stored.select("doc_id", "text", "pieces", "last").join(wanted, "doc_id", "left")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_edit(vocabulary), f"doc_id {kind}, text string, pieces array<int>, last array<int>, ids array<int>, worked long")
