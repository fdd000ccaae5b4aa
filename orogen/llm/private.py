"""Personal data by candidate gradient boosting.

Fixed patterns with checks (email, ip, card by Luhn, phone) give the base spans; all of them stay. Looser
generators propose further spans that may overlap: e-mail with a spelt-out or bracketed sign, numbers with
other separators, phone numbers without a plus. Boosted trees judge each candidate by its
format and its context. Their truth is not what the base patterns cover: examples are base spans, as they are and rewritten
into the loose spellings where they stand; counterexamples are the same with a wrong check digit, range or length, and
candidates of the corpus that fail such a check (`plausible`). Candidates that pass and are no base span have no label and are
left out. The trees are fitted on a bounded sample of documents and on made-up texts (`made`), so that every kind is known
at any input size. A threshold per kind is calibrated for a precision of `PRECISION` on histograms of the scores over all other
documents and the made-up texts that were not fitted. Candidates over it that stand the check of their kind and overlap no base span and no better candidate are added. The checks leave out what looks alike by form: times of day,
rows of small numbers, coordinates, numbers in groups of four. What has the form of personal data and is none, such as a part number
written like a telephone number, has no label in any table; the thresholds are measured without such spans and say nothing about them.

Offsets count code points; ends are exclusive. Null and empty texts have no spans; repeated rows keep one result each.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orogen.llm.boosting import Boosted
from orogen.llm.common import slices, table

KINDS = ("email", "ip", "card", "phone")
#: Documents whose candidates the trees are fitted on, about.
SAMPLE = 20_000
#: Examples that are fitted of one document, at most.
EACH = 16
PRECISION = 0.99
#: Trees that are fitted.
ROUNDS = 60
BINS = 1000

# A number's match starts at the start of a run of digits: one that fails there fails later in the run too.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")

_LOOSE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:@|\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]{1,63}(?:(?:\.| \. | ?(?:\(dot\)|\[dot\]|\{dot\}) ?)[A-Za-z0-9-]{1,63})+", re.IGNORECASE),
    "ip": re.compile(r"(?<![0-9A-Za-z])[0-9]{1,3}(?:[.,:-][0-9]{1,3}){3,7}(?![0-9A-Za-z])"),
    "card": re.compile(r"(?<![0-9A-Za-z])[0-9](?:[ ._-]{0,2}[0-9]){11,22}(?![0-9A-Za-z])"),
    "phone": re.compile(r"(?<![0-9A-Za-z])(?:\+|00)?\(?[0-9][ ()./0-9-]{6,24}[0-9](?![0-9A-Za-z])"),
}
_MARKS = re.compile(r"[^A-Za-z0-9]+")
#: The letters that a span ends with.
_LAST = re.compile(r"[A-Za-z]*\Z")
_SIGN = re.compile(r"@|\(at\)|\[at\]|\{at\}", re.IGNORECASE)


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: each starts where the run of local characters before its sign starts."""
    done = 0
    sign = text.find("@")
    while sign >= 0:
        start = sign
        while start > done and (text[start - 1] in "._%+-" or (text[start - 1].isascii() and text[start - 1].isalnum())):
            start -= 1
        if start < sign and (m := _DOMAIN.match(text, sign + 1)):
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, sign + 1)
        sign = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and then kind as listed."""
    found = [(s, e, "email") for s, e in _emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        found += [(*m.span(), "ip") for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and _luhn(digits):
                found.append((*m.span(), "card"))
    if "+" in text:
        found += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 10 <= sum(map(str.isdigit, m[0])) <= 15]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


class Cover:
    """The stretches that spans cover, in order and apart from each other."""

    def __init__(self, spans: Iterable[tuple[int, int]] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, e in sorted(spans):
            if self.ends and s <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.add(s, e)

    def meets(self, start: int, end: int) -> bool:
        at = bisect_right(self.ends, start)
        return at < len(self.ends) and self.starts[at] < end

    def add(self, start: int, end: int) -> None:
        """A span that meets none of the others."""
        at = bisect_right(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def _kind_of_char(text: str, at: int) -> int:
    if not 0 <= at < len(text):
        return 0
    c = text[at]
    return 1 if c.isspace() else 2 if c.isdigit() else 3 if c.isalpha() else 4


def candidates(text: str) -> list[tuple[int, int, str]]:
    out = []
    if _SIGN.search(text):
        out += [(*m.span(), "email") for m in _LOOSE["email"].finditer(text)]
    if _DIGITS.search(text):
        out += [(*m.span(), kind) for kind in KINDS[1:] for m in _LOOSE[kind].finditer(text)]
    return out


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    """Format and context of a candidate."""
    span = text[start:end]
    marks = _MARKS.findall(span)
    groups = [len(g) for g in _DIGITS.findall(span)] or [0]
    numbers = [int(g) for g in _DIGITS.findall(span) if len(g) < 6] or [0]
    digits = "".join(_DIGITS.findall(span))
    before = text[max(0, start - 30) : start].split()
    return [
        KINDS.index(kind),
        end - start,
        len(digits),
        len(groups),
        groups[0],
        groups[-1],
        max(groups),
        max(numbers),
        float(kind == "card" and 12 <= len(digits) <= 19 and _luhn(digits)),
        sum(map(str.isalpha, span)),
        span.count(" "),
        span.count("(") - span.count(")"),
        float("(" in span),
        span.count("-"),
        len(set(span)),
        _kind_of_char(text, start - 1),
        _kind_of_char(text, end),
        len(before[-1]) if before else 0,
        float(any(map(str.isdigit, before[-1]))) if before else 0.0,
        len(set(marks)),
        span.count(","),
        span.count("."),
        min(groups[1:], default=0),
        float(kind == "phone" and span.startswith(("+", "00"))),
        float(kind == "ip" and max(numbers) <= 255),
        len(_LAST.search(span)[0]),
    ]


def plausible(span: str, kind: str) -> bool:
    """Whether a span stands the check of its kind, whatever its spelling."""
    groups = _DIGITS.findall(span)
    digits = "".join(groups)
    if kind == "email":
        return len(_LAST.search(span)[0]) >= 2
    if kind == "ip":
        same = len(set(_MARKS.findall(span))) == 1
        listed = "," in span and ({len(g) for g in groups} == {1} or {len(g) for g in groups[1:]} == {3})
        if len(groups) != 4 or not same or listed or max(map(int, groups)) > 255:
            return False
        # with other marks than points, times of day and rows of small numbers are none
        time = ":" in span and int(groups[0]) <= 24 and max(map(int, groups[1:3])) < 60
        return "." in span or not (time or max(map(len, groups)) < 3)
    if kind == "card":
        return 14 <= len(digits) <= 19 and _luhn(digits)
    if not 10 <= len(digits.removeprefix("00")) <= 15 or span.count("(") != span.count(")"):
        return False
    if span.startswith(("+", "00")):
        return True
    # A bare run of digits may be any number; groups of four are those of order and account numbers, points beside another mark those of fractions.
    marks = set(span) & set("./-")
    return len(groups) > 1 and set(map(len, groups)) != {4} and not ("." in marks and len(marks) > 1)


def respelt(span: str, kind: str) -> list[str]:
    """A base span as it is and in loose spellings."""
    digits = "".join(_DIGITS.findall(span))
    if kind == "email":
        name, _, host = span.partition("@")
        forms = [f"{name}{at}{dot.join(host.split('.'))}" for at, dot in ((" (at) ", " (dot) "), ("(at)", "(dot)"), (" [at] ", " [dot] "), ("[at]", "."), (" {at} ", " {dot} "), (" (AT) ", "."), ("@", "[dot]"), (" @ ", "."))]
    elif kind == "ip":
        forms = [sep.join(str(int(p)) for p in span.split(".")) for sep in ",:-"]
    elif kind == "card":
        forms = [sep.join(digits[i : i + 4] for i in range(0, len(digits), 4)) for sep in (".", "_", " - ", "  ", " ", "-")]
    else:
        home = [digits, *([digits[1:]] if len(digits) > 10 else []), *([digits[2:]] if len(digits) > 11 else [])]
        cut = [(d[:-7], d[-7:-4], d[-4:]) for d in home]
        forms = [span[1:], f"00{span[1:]}", *[f for a, b, c in cut for f in (f"({a}) {b}-{c}", f"{a} {b} {c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a}/{b}{c}", f"+{a}/{b}-{c}")]]
    return [span, *forms]


def spoilt(spelt: str, kind: str, at: int) -> list[str]:
    """Counterexamples like `spelt`: the spelling is kept, the check fails; `at` varies where."""
    places = [m.start() for m in re.finditer("[0-9]", spelt)]
    if kind == "email":
        return [re.sub(r"[A-Za-z-][A-Za-z0-9-]*\Z", str(10 + at % 90), spelt), re.sub(r"[A-Za-z0-9-]+\Z", "a", spelt)]
    if kind == "card":
        k = places[at % len(places)]
        return [spelt[:k] + str((int(spelt[k]) + 1 + at % 9) % 10) + spelt[k + 1 :]]
    if kind == "ip":
        parts, sep = _DIGITS.findall(spelt), _MARKS.findall(spelt)[0]
        wrong = [str(256 + (at * 37 + int(parts[0])) % 744) if k == at % 4 else p for k, p in enumerate(parts)]
        return [sep.join(wrong), sep.join([*parts, parts[at % 4]]), f"{parts[0]}:{parts[1]}-{parts[2]}:{parts[3]}", ",".join([parts[0], *[p.zfill(3) for p in parts[1:]]]), ",".join(p[-1] for p in parts)]
    digits = "".join(_DIGITS.findall(spelt))
    return [spelt[: places[6 + at % 3] + 1], f"{spelt}-{digits[:6]}", digits[: 8 + at % 8], f"{digits[:7]}.{digits[7:9]}"]


def examples(text: str) -> Iterator[tuple[list[float], bool]]:
    """(features, truth) of the examples and counterexamples that a text gives."""
    base = base_spans(text)
    for s, e, kind in base:
        before, after = text[max(0, s - 60) : s], text[e : e + 60]
        for n, spelt in enumerate(respelt(text[s:e], kind)):
            for form, good in [(spelt, True), *((f, False) for f in (spoilt(spelt, kind, s + n) if n % 3 == s % 3 else ()))]:
                if plausible(form, kind) == good and (m := _LOOSE[kind].match(before + form + after, len(before))) and m.end() == len(before) + len(form):
                    yield features(before + form + after, *m.span(), kind), good
    covers = {kind: Cover((s, e) for s, e, k in base if k == kind) for kind in KINDS}
    for s, e, kind in candidates(text):
        if not plausible(text[s:e], kind) and not covers[kind].meets(s, e):
            yield features(text, s, e, kind), False


def made(n: int = 120, seed: int = 8) -> list[str]:
    """Texts with base spans of each kind, always the same."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9)))
    number = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    texts = []
    for i in range(n):
        stem = f"{rng.integers(3, 7)}{number((12, 13, 14, 14, 14, 17)[i % 6])}"
        card = next(f"{stem}{c}" for c in range(10) if _luhn(f"{stem}{c}"))
        tails = (f"{word()}.{word()}@{word()}.{('com', 'org', 'net', 'de', 'info')[i % 5]}", f"{word()}{i}@{word()}.{word()}.{('com', 'uk')[i % 2]}", ".".join(map(str, rng.integers(0, 256, 4))), card, f"+{1 + i % 98} {number(3)} {number(3)}{' -'[i % 2]}{number(4)}", f"+{1 + i % 9}{number(9 + i % 5)}")
        tails = (*tails, *[".".join(map(str, rng.integers(0, 256, 4) // (1, 1, k, k))) for k in (1, 1, 5, 25)], f"10.{rng.integers(0, 9)}.{rng.integers(0, 99)}.{rng.integers(0, 99)}")
        texts += [f"{word()} {word()}{('', ':', ',', ' is')[i % 4]} {tail}{(' ', '. ', ', ', chr(10))[i // 4 % 4]}{word()} {word()}" for tail in tails]
    return texts


@dataclass
class Finder:
    """The trees and the threshold of each kind (over 1: nothing is added)."""

    trees: Boosted
    thresholds: dict[str, float]

    def added(self, text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        cover, taken = Cover((s, e) for s, e, _ in base), Cover()
        # the trees rank candidates, but none that fails the check of its kind is added
        free = [(s, e, k) for s, e, k in candidates(text) if not cover.meets(s, e) and plausible(text[s:e], k)]
        if not free:
            return []
        p = self.trees.predict(np.array([features(text, *c) for c in free], dtype=np.float64))
        kept: list[tuple[int, int, str]] = []
        for k in np.argsort(-p, kind="stable"):
            s, e, kind = free[k]
            if p[k] >= self.thresholds[kind] and not taken.meets(s, e):
                taken.add(s, e)
                kept.append(free[k])
        return kept

    def spans(self, text: str) -> list[tuple[int, int, str, bool]]:
        base = base_spans(text)
        both = [(*b, True) for b in base] + [(*a, False) for a in self.added(text, base)]
        return sorted(both, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def _threshold(right: np.ndarray, wrong: np.ndarray) -> float:
    """From the histograms of a kind's scores: the least bin from which on the precision is reached, over 1 if none has it."""
    good, bad = right[::-1].cumsum(), wrong[::-1].cumsum()
    fine = np.flatnonzero((good > 0) & (good >= PRECISION * (good + bad)))
    return max(0.5, (BINS - 1 - int(fine[-1])) / BINS) if len(fine) else 2.0


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Finder:
    count = docs.count()
    if not count:
        return Finder(Boosted(), dict.fromkeys(KINDS, 2.0))
    # At most `sample` documents, and at most 7 of 10, are fitted on; the others are for the thresholds.
    among, taken = (10, 7) if 0.7 * count <= sample else (-(-count // sample), 1)
    fitted = F.pmod(F.xxhash64(id_col, text_col), F.lit(among)) < taken
    text = F.col(text_col).alias("text")

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for piece in slices(batch, 0):
                got = []
                for t in piece.column(0).to_pylist():
                    own = [(np.array(x).tobytes(), y) for x, y in examples(t or "")]
                    got += own if len(own) <= EACH else [own[k] for k in np.random.default_rng(len(t)).choice(len(own), EACH, replace=False)]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in got], pa.binary()), pa.array([y for _, y in got], pa.bool_())], ["x", "y"])

    got = docs.where(fitted).select(text).mapInArrow(rows, "x binary, y boolean").toPandas().sort_values(["x", "y"])
    always = [[e for t in texts for e in examples(t)] for texts in (made(), made(50, 9))]  # to fit, and for the thresholds
    x = np.array([np.frombuffer(b, np.float64) for b in got["x"]] + [e[0] for e in always[0]], dtype=np.float64)
    trees = Boosted(rounds=ROUNDS).fit(x, np.array([*got["y"], *(e[1] for e in always[0])], dtype=float))

    def counted(own: list[tuple[list[float], bool]], sums: np.ndarray) -> None:
        x = np.array([e[0] for e in own], dtype=np.float64)
        at = np.minimum((trees.predict(x) * BINS).astype(np.int64), BINS - 1)
        np.add.at(sums, (x[:, 0].astype(np.int64), at, [int(e[1]) for e in own]), 1)

    def histograms(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(KINDS), BINS, 2), dtype=np.int64)
        for batch in parts:
            for piece in slices(batch, 0):
                for t in piece.column(0).to_pylist():
                    if own := list(examples(t or "")):
                        counted(own, sums)
        places = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([*[pa.array(p.astype(np.int32)) for p in places], pa.array(sums[places])], ["kind", "bin", "good", "n"])

    scored = docs.where(~fitted).select(text).mapInArrow(histograms, "kind int, bin int, good int, n long")
    sums = np.zeros((len(KINDS), BINS, 2), dtype=np.int64)
    for kind, at, good, n in scored.groupBy("kind", "bin", "good").agg(F.sum("n")).collect():
        sums[kind, at, good] = n
    counted(always[1], sums)
    return Finder(trees, {k: _threshold(sums[i, :, 1], sums[i, :, 0]) for i, k in enumerate(KINDS)})


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())]))


def find(docs: DataFrame, finder: Finder, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, spans: array of (kind, start, stop, base)) for each row of `docs`."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("__text"))

    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for piece in slices(batch, 1):
                spans = [[{"kind": k, "start": s, "stop": e, "base": b} for s, e, k, b in finder.spans(t or "")] for t in piece.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(spans, _SPANS)], [id_col, "spans"])

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(found, f"`{id_col}` {kind}, spans array<struct<kind:string,start:long,stop:long,base:boolean>>")


def redact(docs: DataFrame, finder: Finder, text_col: str = "text") -> DataFrame:
    """`docs` with each span of the text replaced by its kind in brackets; overlapping spans are replaced as one."""
    place = docs.columns.index(text_col)

    def redacted(text: str | None) -> str | None:
        out, done = [], 0
        for s, e, kind, _ in finder.spans(text or ""):
            if s >= done:
                out += [text[done:s], f"[{kind.upper()}]"]
            done = max(done, e)
        return "".join([*out, text[done:]]) if out else text

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for piece in slices(batch, place):
                texts = pa.array([redacted(t) for t in piece.column(place).to_pylist()], pa.string())
                yield piece.set_column(place, piece.schema.field(place), texts)

    return docs.mapInArrow(batches, docs.schema)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find(docs, fit(docs))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    added = F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added")
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), added)
