"""Personal data: exact base patterns, and a linear-chain conditional random field for other spellings.

Base spans follow fixed patterns. A conditional random field over word-shape features, fitted to a
small labelled table, reads the surroundings of digits, at signs and bracketed ``at``/``dot`` and adds
spans in spellings that the patterns miss (``name [at] host [dot] com``, ``(499) 555-6503``, dotted
card numbers). An added span must not touch a base span and must be sound for its kind (digit counts,
byte ranges, Luhn sum); a base span is never changed. Letters far from such marks are outside by
definition, so most of a text is never decoded.
"""

from __future__ import annotations

import hashlib
import random
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from panelcast.llm.common import lean, reading, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone")
LABELLED_ROWS = 5000  # most labelled rows that a fit reads
REACH = 32
TOKENS, CELLS = 4096, 1 << 17  # tokens whose features are held at a time; padded tokens of a decoding
ROUNDS, RATE, DECAY = 80, 0.1, 1e-3

Span = tuple[int, int]

# --- base patterns --------------------------------------------------------------------

NAME_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(r"[0-9]")
DIGITS = re.compile(r"[0-9]+")
DOTTED = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits_of(s: str) -> list[int]:
    return [int(c) for c in s if c in "0123456789"]


def luhn(s: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits_of(s))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Per at sign: the name characters before it, back to the previous address at most."""
    done, at = 0, text.find("@")  # a name starts no earlier than done
    while at >= 0:
        start = done + len(text[done:at].rstrip(NAME_CHARACTERS))
        host = HOST.match(text, at) if start < at else None
        done = at + 1
        if host:
            done = host.end()
            yield start, done
        at = text.find("@", done)


def addresses(text: str) -> Iterator[Span]:
    """Every four numbers of a dotted sequence are one match; those over 255 are dropped."""
    for m in DOTTED.finditer(text):
        whole = m.group()
        numbers = [x.span() for x in DIGITS.finditer(whole)]
        for i in range(0, len(numbers) - 3, 4):
            part = whole[numbers[i][0] : numbers[i + 3][1]]
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in part.split(".")):
                yield m.start() + numbers[i][0], m.start() + numbers[i + 3][1]


def base_spans(text: str) -> dict[str, list[Span]]:
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = list(emails(text))
    if DIGIT.search(text):
        found["ip"] = list(addresses(text))
        found["card"] = [
            m.span() for m in CARD.finditer(text) if 16 <= sum(map(str.isdigit, m.group())) <= 19 and luhn(m.group())
        ]
        if "+" in text:
            found["phone"] = [m.span() for m in PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return found


# --- labelled table -------------------------------------------------------------------


def examples(rows: int = 600, seed: int = 7) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """A small labelled table ``text, spans``: sentences around personal data in several spellings, and
    around other numbers and signs; in every third row a list of data of one kind."""
    r = random.Random(seed)
    words = "the of and her les une der die con para oner ation thing ver sich eau ment ciones este about".split()

    def n(k: int) -> str:
        return "".join(r.choice("0123456789") for _ in range(k))

    def word() -> str:
        return "".join(r.choice("abcdeilnorstu") for _ in range(r.randint(3, 8)))

    def card(sep: str) -> str:
        d = n(15)
        check = next(c for c in "0123456789" if luhn(d + c))
        return sep.join((d + check)[i : i + 4] for i in range(0, 16, 4))

    def email() -> str:
        at, dot = r.choice([("@", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"), ("(at)", ".")])
        name = r.choice([word(), f"{word()}.{n(2)}", f"{word()}.{word()}"])
        return f"{name}{at}{r.choice([word(), 'mail' + n(1), 'example'])}{dot}{r.choice(['com', 'org', 'net', 'de'])}"

    def phone() -> str:
        a, b, c = n(3), n(3), n(4)
        return r.choice([f"+{n(1)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{n(2)} {a} {b} {c}", f"({a}) {b} {c}"])

    def ip() -> str:
        return ".".join(str(r.randint(0, 255)) for _ in range(4))

    def other() -> str:
        return r.choice(
            [
                n(4), n(2), n(16), f"{n(1)}.{n(2)}.{n(1)}", f"{n(4)}-{n(2)}-{n(2)}", f"{n(1)},{n(2)}", f"{n(3)}.{n(2)}",
                f"{n(2)}:{n(2)}", f"({n(4)})", f"#{n(5)}", f"{n(2)}%", f"v{n(1)}.{n(1)}", f"{n(3)}-{n(2)}", f"{n(8)}",
                f"@{word()}", "[at]", f"{word()}{n(2)}", f"{n(5)} {n(3)}", f"({n(1)}) {word()}", f"{n(4)}/{n(4)}", n(12),
                "".join(r.choice("0123456789abcdef") for _ in range(24)),
            ]
        )

    cues = {"email": ["mail", "write to", ""], "phone": ["call", "tel.", "phone:", ""], "ip": ["from", "host", ""]}
    cues["card"] = ["card", "card no.", "paid with", ""]
    made_by = {"email": email, "phone": phone, "ip": ip, "card": lambda: card(r.choice(["", " ", "-", "."]))}
    out = []
    for row in range(rows):
        text, spans = " ".join(r.choice(words) for _ in range(r.randint(1, 4))), []
        for _ in range(r.randint(1, 2) if row % 3 else 0):
            kind = r.choice([*KINDS, None, None])
            text += r.choice([" ", " ", ", ", "### "])
            if kind:
                text += r.choice(cues[kind])
                text += " " if not text.endswith(" ") else ""
                made = made_by[kind]()
                spans.append((kind, len(text), len(text) + len(made)))
                text += made
            else:
                text += other()
            text += r.choice([" ", ", ", ". ", "### "]) + " ".join(r.choice(words) for _ in range(r.randint(1, 3)))
        if row % 3 == 0:
            kind, between = r.choice(KINDS), r.choice([", ", "; ", "\n", " ", " | ", " and "])
            for i in range(r.randint(2, 4)):
                made = card(r.choice(["", "-", "."])) if kind == "card" and between.isspace() else made_by[kind]()
                text += between if i else r.choice([" ", "\n", ": "])
                spans.append((kind, len(text), len(text) + len(made)))
                text += made
        out.append((text, spans))
    return out


# --- field ----------------------------------------------------------------------------

TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
KNOWN_WORDS = frozenset("at dot com org net mail email tel phone call card ip host from".split())


def shape(token: str) -> str:
    if token.isdigit():
        return f"d{min(len(token), 9)}" + ("s" if len(token) <= 3 and int(token) <= 255 else "")
    if token.isalpha():
        low = token.lower()
        return low if low in KNOWN_WORDS else ("X" if token.isupper() else "Xx" if token[0].isupper() else "x") + str(min(len(token), 3))
    return token


def features(text: str, spans: list[Span]) -> list[list[str]]:
    """Word-shape features of each token: itself, two neighbours on either side, and pairs."""
    shapes = ["<", "<", *(shape(text[a:b]) for a, b in spans), ">", ">"]
    joined = ["", *("" if x[1] == y[0] else "_" for x, y in zip(spans, spans[1:], strict=False)), "_"]
    out = []
    for i in range(len(spans)):
        pp, p, c, q, qq = shapes[i : i + 5]
        left, right = joined[i], joined[i + 1]
        out.append([f"0{c}", f"1{p}{left}", f"2{right}{q}", f"3{pp}", f"4{qq}", f"5{p}{left}{c}", f"6{c}{right}{q}", f"7{p}{left}{c}{right}{q}"])
    return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Field:
    """Emission weights by feature and label, and transition weights between labels."""

    def __init__(self, index: dict[str, int], emission: np.ndarray, transition: np.ndarray):
        self.index, self.emission, self.transition = index, emission, transition

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(rows), len(LABELS)))
        for i, names in enumerate(rows):
            known = [self.index[x] for x in names if x in self.index]
            out[i] = self.emission[known].sum(axis=0)
        return out

    def emissions(self, text: str, tokens: list[Span]) -> np.ndarray:
        """Scores of all tokens of a stretch, whose features reach two neighbours far. As in the fit, no
        stretch begins inside a span."""
        out = np.zeros((len(tokens), len(LABELS)))
        for k in range(0, len(tokens), TOKENS):
            low = max(0, k - 2)
            rows = features(text, tokens[low : k + TOKENS + 2])
            out[k : k + TOKENS] = self.scores(rows[k - low : k - low + TOKENS])
        out[:1, [i for i, x in enumerate(LABELS) if x[0] == "I"]] -= 1e4
        return out

    def decode(self, sequences: list[np.ndarray]) -> list[list[int]]:
        """Best label sequences, all of a batch in step (Viterbi)."""
        if not sequences:
            return []
        size, longest = len(sequences), max(map(len, sequences))
        lengths = np.array([len(s) for s in sequences])
        scores = np.zeros((size, longest, len(LABELS)))
        for i, s in enumerate(sequences):
            scores[i, : len(s)] = s
        best = scores[:, 0]
        back = np.zeros((size, longest, len(LABELS)), np.int8)
        for t in range(1, longest):
            options = best[:, :, None] + self.transition[None]
            back[:, t] = options.argmax(axis=1)
            step = options.max(axis=1) + scores[:, t]
            best = np.where((t < lengths)[:, None], step, best)
        out = []
        for i, n in enumerate(lengths):
            path = [int(best[i].argmax())]
            for t in range(n - 1, 0, -1):
                path.append(int(back[i, t, path[-1]]))
            out.append(path[::-1])
        return out


def fit(labelled: DataFrame) -> Field:
    """Fit to a labelled table ``text, spans`` of at most ``LABELLED_ROWS`` rows (more is an error)."""
    rows = labelled.select("text", "spans").limit(LABELLED_ROWS + 1).collect()
    if len(rows) > LABELLED_ROWS:
        raise ValueError(f"the labelled table is bounded to {LABELLED_ROWS} rows")
    return fit_rows([(x["text"], [tuple(s) for s in x["spans"]]) for x in rows])


def fit_rows(rows: list[tuple[str, list[tuple[str, int, int]]]]) -> Field:
    """Penalised maximum likelihood by Adam steps on the whole table (forward-backward in step)."""
    index: dict[str, int] = {}
    sequences, gold = [], []
    for text, spans in rows:
        tokens = [m.span() for m in TOKEN.finditer(text)]
        labels = np.zeros(len(tokens), np.int64)
        for kind, start, end in spans:
            inside = [i for i, (a, b) in enumerate(tokens) if a >= start and b <= end]
            labels[inside] = LABELS.index(f"I-{kind}")
            labels[inside[:1]] = LABELS.index(f"B-{kind}")
        sequences.append([[index.setdefault(x, len(index)) for x in names] for names in features(text, tokens)])
        gold.append(labels)
    size, longest, width, labels = len(rows), max(map(len, gold)), len(sequences[0][0]), len(LABELS)
    used, want, mask = np.full((size, longest, width), len(index)), np.zeros((size, longest), np.int64), np.zeros((size, longest), bool)
    for i, s in enumerate(sequences):
        used[i, : len(s)], want[i, : len(s)], mask[i, : len(s)] = s, gold[i], True
    allowed = np.array([[b[0] != "I" or a[1:] == b[1:] for b in LABELS] for a in LABELS])  # I follows its own B or I
    wall = np.where(allowed, 0.0, -1e4)
    weights = [np.zeros((len(index) + 1, labels)), np.zeros((labels, labels))]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    hot = np.eye(labels)[want] * mask[:, :, None]
    pairs = np.einsum("nti,ntj->ij", hot[:, :-1], hot[:, 1:])
    for step in range(1, ROUNDS + 1):
        emission = weights[0][used].sum(axis=2)
        emission[:, 0, [i for i, x in enumerate(LABELS) if x[0] == "I"]] -= 1e4
        transition = weights[1] + wall
        ahead, behind = np.zeros((size, longest, labels)), np.zeros((size, longest, labels))
        ahead[:, 0] = emission[:, 0]
        for t in range(1, longest):
            moved = _logsum(ahead[:, t - 1, :, None] + transition, 1) + emission[:, t]
            ahead[:, t] = np.where(mask[:, t, None], moved, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            moved = _logsum(transition + (emission[:, t + 1] + behind[:, t + 1])[:, None], 2)
            behind[:, t] = np.where(mask[:, t + 1, None], moved, 0.0)
        total = _logsum(ahead[:, -1], 1)
        expected = np.exp(ahead + behind - total[:, None, None]) * mask[:, :, None]
        joint = ahead[:, :-1, :, None] + transition + (emission + behind)[:, 1:, None] - total[:, None, None, None]
        joint = (np.exp(np.minimum(joint, 0)) * mask[:, 1:, None, None]).sum(axis=(0, 1))
        gap = np.repeat((hot - expected).reshape(-1, labels), width, axis=0)
        slope = np.stack([np.bincount(used.ravel(), gap[:, k], len(index) + 1) for k in range(labels)], axis=1)
        for w, g, (m, v) in zip(weights, (slope, pairs - joint), moments, strict=True):
            g = g / size - DECAY * w
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(index, weights[0][:-1], weights[1] + wall)


# --- finding --------------------------------------------------------------------------

SPACE = re.compile(r"\s")
MARK = re.compile(r"[0-9@]+|[\[({<]\s?(?:at|dot)\s?[\])}>]", re.IGNORECASE)


def windows(text: str) -> Iterator[Span]:
    """Surroundings of the marks, out to the next white space, overlapping ones joined."""
    start = end = -1
    for m in MARK.finditer(text):
        a, b = m.start() - REACH, m.end() + REACH
        if a > end:  # back over the word that the edge divides, to the window before at most
            before = text[max(0, end) : a]
            a -= len(before.rsplit(None, 1)[-1]) if before and not before[-1].isspace() else 0
        if b > end:
            space = SPACE.search(text, b)
            b = space.start() if space else len(text)
        if end >= 0 and a <= end:
            end = max(end, b)
        else:
            if end >= 0:
                yield start, end
            start, end = max(0, a), b
    if end >= 0:
        yield start, end


def sound(kind: str, s: str) -> bool:
    n = len(digits_of(s))
    if kind == "email":
        return bool(re.search(r"@|\bat\b", s, re.IGNORECASE) and re.search(r"\.|\bdot\b", s, re.IGNORECASE) and re.search(r"[^\W\d_]", s))
    if kind == "ip":
        parts = re.findall(r"[0-9]+", s)
        return len(parts) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in parts)
    if kind == "card":
        return 13 <= n <= 19 and luhn(s)
    return 8 <= n <= 15 and len(re.findall(r"[0-9]+", s)) >= 3


def added_spans(texts: list[str], base: list[dict[str, list[Span]]], field: Field) -> list[list[tuple[str, int, int]]]:
    """Sound spans of the field that touch no base span."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    held = []
    for i, text in enumerate(texts):
        for a, b in windows(text):
            held.append((i, [m.span() for m in TOKEN.finditer(text, a, b)]))
    held.sort(key=lambda x: len(x[1]))
    k = 0
    while k < len(held):  # a stretch is decoded whole, long ones a few at a time
        n = 1
        while n < 256 and k + n < len(held) and (n + 1) * len(held[k + n][1]) <= CELLS:
            n += 1
        part = held[k : k + n]
        k += n
        paths = field.decode([field.emissions(texts[i], tokens) for i, tokens in part])
        for (i, tokens), path in zip(part, paths, strict=True):
            for kind, a, b in joined(tokens, path):
                if sound(kind, texts[i][a:b]) and not any(a < y and x < b for s in base[i].values() for x, y in s):
                    out[i].append((kind, a, b))
    return out


def joined(tokens: list[Span], path: list[int]) -> Iterator[tuple[str, int, int]]:
    open_kind, start, end = None, 0, 0
    for (a, b), label in [*zip(tokens, path, strict=True), ((0, 0), 0)]:
        name = LABELS[label]
        if open_kind and name != f"I-{open_kind}":
            yield open_kind, start, end
            open_kind = None
        if name[0] == "B" or (name[0] == "I" and open_kind is None):
            open_kind, start = name[2:], a
        end = b


def find(texts: list[str | None], field: Field) -> list[tuple[dict[str, list[Span]], list[tuple[str, int, int]]]]:
    """Base spans and all spans (by kind as listed, then start) of each text."""
    whole = [x or "" for x in texts]
    base = [base_spans(x) for x in whole]
    out = []
    for b, extra in zip(base, added_spans(whole, base, field), strict=True):
        spans = {(k, *s) for k in KINDS for s in b[k]} | set(extra)
        out.append((b, sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))))
    return out


def line(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_batches(field: Field, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find(batch["text"].to_pylist(), field)
            rows = {f: batch[f] for f in fields}
            for kind in KINDS:
                rows[f"n_{kind}"] = pa.array([len(b[kind]) for b, _ in found], pa.int64())
            lines = [line([(k, *s) for k in KINDS for s in b[k]]) for b, _ in found]
            rows["base_sha256"] = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in lines], pa.string())
            rows["spans"] = pa.array([line(s) for _, s in found], pa.string())
            rows["n_added"] = pa.array([len(s) - sum(map(len, b.values())) for b, s in found], pa.int64())
            yield pa.RecordBatch.from_pydict(rows)

    return run


def detect(df: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` of every row.

    The four counts and the digest are those of base spans; ``spans`` lists all spans and ``n_added``
    counts the added ones. Positions are code points. Null and empty texts have no spans; repeated rows
    give repeated results; other columns are not read.
    """
    small_batches(df.sparkSession)
    rows = reading(df, doc_id=doc_id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(
        find_batches(field, ["doc_id"]), f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added long"
    )


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first
    start (then the longest) decides."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact_batches(field: Field, schema: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            found = find(texts, field)
            clean = [x if x is None or not s else redacted(x, s) for x, (_, s) in zip(texts, found, strict=True)]
            rows = {c: batch[c] for c in schema} | {"text": pa.array(clean, pa.string())}
            if "n_chars" in rows:
                lengths = [n if x is y else len(y) for x, y, n in zip(texts, clean, batch["n_chars"].to_pylist(), strict=True)]
                rows["n_chars"] = pa.array(lengths, batch["n_chars"].type)
            yield pa.RecordBatch.from_pydict(rows)

    return lean(run)


def redact(df: DataFrame, field: Field) -> DataFrame:
    """The same table with personal data in ``text`` replaced, and ``n_chars``, where there is one, of the
    new text. A null text stays null; the other columns are carried through."""
    small_batches(df.sparkSession)
    return df.mapInArrow(redact_batches(field, df.columns), df.schema)
