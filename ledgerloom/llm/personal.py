"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds what they miss.

The patterns take the leftmost match and drop it when a check fails, so neighbours that run into each other (a phone
number and a card number with a blank between) are lost together; and they know nothing of *secrets*, keys and tokens of
letters and digits at random.  The field looks at windows of text around digits and at-signs, cuts them into atoms (runs of
letters, runs of digits, long runs of both, single characters), and scores *whole segments* of up to ``MAX_ATOMS`` atoms by
features of the segment as such: number and grouping of digits, separators, checksum, variety of signs, edges, the word
before the segment.  Dynamic programming over atoms then chooses boundaries and types together.  Its weights are fitted here, by
likelihood, on windows of a bounded sample in which the patterns' matches are taken as true, and on made-up ones, which are
all that tells of secrets.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import blocks, whole

#: The kinds in order and their patterns.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: All kinds that the field tells apart.
TYPES = (*KINDS, "secret")
NEEDED = {"email": "@", "phone": "+", "ip": ".", "card": ""}
CUES = {"mail", "email", "write", "ip", "host", "server", "card", "visa", "pay", "tel", "phone", "call", "mobile", "fax"}
#: Words that stand before a secret.
SECRET_CUES = {"token", "key", "apikey", "api_key", "secret", "password", "passwd", "pwd", "auth", "bearer", "credential"}

MAX_ATOMS = 24
MARKED = re.compile(r"[0-9@]+")
MIXED = r"(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{16,}"
ATOM = re.compile(MIXED + r"|[A-Za-z]+|[0-9]+|.", re.DOTALL)
DIGITS = re.compile(r"[0-9]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = 2 * v - 9 if v > 4 else 2 * v
        total += v
    return total % 10 == 0


def valid(kind: str, text: str) -> bool:
    """The check that a match of a kind must pass."""
    if kind == "email":
        return PATTERNS["email"].fullmatch(text) is not None
    if kind == "secret":
        signs = [c for c in text if c.isalnum()]
        return len(signs) >= 16 and sum(c.isdigit() for c in signs) >= 3 and sum(c.isalpha() for c in signs) >= 3 and len(set(signs)) >= 8
    parts = DIGITS.findall(text)
    n = sum(map(len, parts))
    if kind == "ip":
        return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= n <= 19 and luhn("".join(parts))
    return 9 <= n <= 15


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its check, by kind and start; kinds may overlap."""
    out = []
    for kind in KINDS:
        if NEEDED[kind] in text:
            out += [(kind, m.start(), m.end()) for m in PATTERNS[kind].finditer(text) if kind == "email" or valid(kind, m.group())]
    return out


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around digits and at-signs, out to white space; words a single blank apart are one stretch."""
    start = end = -1
    for m in MARKED.finditer(text):
        if m.start() < end:
            continue
        a = m.start()
        while a > 0 and not text[a - 1].isspace():
            a -= 1
        b = m.end()
        while b < len(text) and not text[b].isspace():
            b += 1
        if end >= 0 and a == end + 1 and text[end] == " ":
            end = b
            continue
        if end >= 0:
            yield start, end
        start, end = a, b
    if end >= 0:
        yield start, end


@dataclass
class Lattice:
    """A window's atoms and its candidate segments: (first atom, end atom, features)."""

    start: int
    edges: list[int]
    plain: list[str]
    segments: list[tuple[int, int, tuple[str, ...]]] = field(default_factory=list)


def lattice(text: str, start: int, end: int) -> Lattice:
    """Candidates hold an at-sign, or a long run of letters and digits, or no letter and nine digits or four runs of them;
    they begin and end with a sign."""
    found = [(m.start(), m.end()) for m in ATOM.finditer(text, start, end)]

    def kind_of(a: int, b: int) -> str:
        part = text[a:b]
        if not part.isascii() or not part.isalnum():
            return part[0]
        return "d" if part.isdigit() else "a" if part.isalpha() else "m"

    kind = [kind_of(a, b) for a, b in found]
    out = Lattice(start, [a for a, _ in found] + [end], kind)
    for i, first in enumerate(kind):
        if first not in "dam+(":
            continue
        cue, mixed = _cue(text, found[i][0]), 0
        digits = runs = ats = 0
        letters = False
        for j in range(i, min(len(kind), i + MAX_ATOMS)):
            k = kind[j]
            if k == "d":
                digits, runs = digits + found[j][1] - found[j][0], runs + 1
            elif k == "a":
                letters = True
            elif k == "m":
                letters, mixed = True, mixed + 1
            elif k == "@":
                ats += 1
            elif k not in " .-()+_%":
                break
            if ats > 1 or (k == " " and (ats or letters)):
                break
            if k in "dam" and (ats or mixed or (not letters and (digits >= 9 or runs >= 4))):
                out.segments.append((i, j + 1, _features(text, found[i][0], found[j][1], digits, runs, ats, letters, mixed > 0, cue)))
    return out


BEFORE = re.compile(r"([A-Za-z_]+)([^A-Za-z_]{0,6})$")


def _cue(text: str, at: int) -> str:
    """The word before a segment, if it says something about what follows, and how it is set off."""
    before = BEFORE.search(text, max(0, at - 24), at)
    if not before:
        return "cue=none"
    word, gap = before[1].lower(), before[2]
    if word in SECRET_CUES:
        return "cue=secret" + ("=" if "=" in gap or ":" in gap else "")
    return "cue=" + word if word in CUES and "\n" not in gap else "cue=none"


def _features(text: str, a: int, b: int, digits: int, runs: int, ats: int, letters: bool, mixed: bool, cue: str) -> tuple[str, ...]:
    segment = text[a:b]
    left, right = text[a - 1 : a], text[b : b + 2]
    out = ["bias", f"digits={min(digits, 20)}" if not ats else "digits=@", f"runs={min(runs, 7)}" if not ats else "runs=@", cue]
    out.append("open=" + ("+" if segment[0] == "+" else "(" if segment[0] == "(" else "d" if segment[0].isdigit() else "a"))
    for name, there in (("at", ats), ("letters", letters), ("blank", " " in segment), ("paren", "(" in segment), ("dash", "-" in segment), ("dot", "." in segment)):
        if there:
            out.append(name)
    if mixed and not ats:
        signs = [c for c in segment if c.isalnum()]
        figures = sum(c.isdigit() for c in signs) / len(signs)
        out.append("mixed")
        out.append(f"long={min(len(signs) // 8, 5)}")
        out.append("mixed hex" if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", segment) else "mixed other")
        out.append(f"figures={int(4 * figures)}")
        # at random, letters and digits take turns often
        turns = sum(a.isdigit() != b.isdigit() for a, b in zip(signs, signs[1:], strict=False)) / len(signs)
        out.append(f"turns={min(int(10 * turns), 5)}")
        out.append("quoted" if left in ("\"", "'", "`") and right[:1] == left else "bare")
    elif not ats:
        parts = DIGITS.findall(segment)
        if runs == 4 and segment.count(".") == 3 and len(segment) == digits + 3:
            out.append("quad" if all(len(p) <= 3 and int(p) <= 255 for p in parts) else "quad over")
        if 13 <= digits <= 19:
            out.append("luhn" if luhn("".join(parts)) else "no luhn")
        out.append("groups=" + (",".join(str(min(len(p), 9)) for p in parts) if runs <= 5 else "many"))
        if re.search(r"[^0-9]{3}|\+.*\+", segment):
            out.append("odd marks")
    else:
        local, _, host = segment.partition("@")
        out.append("host dot" if "." in host.strip(".") else "host plain")
        out.append("host clean" if re.fullmatch(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*", host) else "host odd")
        if not local:
            out.append("no local")
    cut = lambda c: c.isalnum() or c in "+@_"
    if left and (cut(left) or (left in ".-%(" and a > 1 and text[a - 2].isalnum())):
        out.append("cut left")
    if right and (cut(right[0]) or (right[0] in ".-@" and len(right) > 1 and right[1].isalnum())):
        out.append("cut right")
    return tuple(out)


class Field:
    """Weights by (kind, feature); an atom outside of any segment scores by what it is."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.weights = weights or {}

    def _outside(self, graph: Lattice) -> list[float]:
        w = self.weights
        return [w.get(("outside", k if k in "dam@+" else "other"), 0.0) for k in graph.plain]

    def _scored(self, graph: Lattice) -> list[tuple[int, int, str, tuple[str, ...], float]]:
        w = self.weights
        return [(i, j, kind, fs, sum(w.get((kind, f), 0.0) for f in fs)) for i, j, fs in graph.segments for kind in TYPES]

    def best(self, graph: Lattice) -> list[Span]:
        """The highest-scoring way to cut the window into segments and atoms outside."""
        n = len(graph.plain)
        ending: dict[int, list] = {}
        for item in self._scored(graph):
            ending.setdefault(item[1], []).append(item)
        value, came = [0.0] * (n + 1), [None] * (n + 1)
        for j, alone in enumerate(self._outside(graph), start=1):
            value[j] = value[j - 1] + alone
            for i, _, kind, _, score in ending.get(j, ()):
                if value[i] + score > value[j]:
                    value[j], came[j] = value[i] + score, (i, kind)
        out, j = [], n
        while j > 0:
            if came[j] is None:
                j -= 1
            else:
                i, kind = came[j]
                out.append((kind, graph.edges[i], graph.edges[j]))
                j = i
        return out[::-1]

    def gradient(self, graph: Lattice, gold: set[Span]) -> dict[tuple[str, str], float]:
        """Of the log-likelihood: observed less expected features."""
        n = len(graph.plain)
        scored, outside = self._scored(graph), self._outside(graph)
        ending, opening = {}, {}
        for item in scored:
            ending.setdefault(item[1], []).append(item)
            opening.setdefault(item[0], []).append(item)
        forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            forward[j] = _logsum([forward[j - 1] + outside[j - 1], *[forward[x[0]] + x[4] for x in ending.get(j, ())]])
        for i in range(n - 1, -1, -1):
            backward[i] = _logsum([backward[i + 1] + outside[i], *[backward[x[1]] + x[4] for x in opening.get(i, ())]])
        total, out, covered = forward[n], {}, set()
        for i, j, kind, fs, score in scored:
            true = (kind, graph.edges[i], graph.edges[j]) in gold
            if true:
                covered.update(range(i, j))
            change = true - math.exp(min(0.0, forward[i] + score + backward[j] - total))
            if abs(change) > 1e-6:
                for f in fs:
                    out[kind, f] = out.get((kind, f), 0.0) + change
        for j in range(n):
            change = (j not in covered) - math.exp(min(0.0, forward[j] + outside[j] + backward[j + 1] - total))
            key = ("outside", graph.plain[j] if graph.plain[j] in "dam@+" else "other")
            out[key] = out.get(key, 0.0) + change
        return out


def _logsum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


@dataclass(frozen=True)
class Fit:
    """Bounds of the fit: texts read, windows taken from each, windows used, made-up windows, and passes over them."""

    texts: int = 3_000
    windows_a_text: int = 4
    windows: int = 600
    passes: int = 12
    rate: float = 0.3
    made_up: int = 200
    decay: float = 0.002


#: Made-up windows, so that each kind is known even where the sample has none.
EXAMPLES = (
    "ask jo.doe@mail.example.org now", "x_7@a-b.example.com", "from 10.0.0.1 to 192.168.7.254", "paid 4111 1111 1111 1111 today", "5500005555555559",
    "card 4012-8888-8888-1881", "+1 (212) 555-0123", "call +49 30 1234567", "+442079460018", "version 2.0. of 1999-2004", "order 12345678901234567 of 3",
    "@home 3@4", "999.300.1.2", "sum 1 2 3 4 5 6 7 8 9 10 11 12",
)


def made_up_secrets(n: int, seed: int) -> list[tuple[str, set[Span]]]:
    """Windows with a secret, and others with long words of letters and digits that are none."""
    rng = random.Random(seed)
    signs = {"hex": "0123456789abcdef", "upper": "0123456789ABCDEF", "any": "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    words = ["photo", "backup", "final", "version", "build", "release", "section", "article", "draft", "report", "figure", "appendix", "invoice", "chapter"]
    out = []
    for k in range(n):
        if k % 2:
            secret = "".join(rng.choice(signs[rng.choice(sorted(signs))]) for _ in range(rng.choice([20, 24, 32, 40, 64])))
            if not valid("secret", secret):
                continue
            quote = rng.choice(["\"", "\"", "'", ""])
            cue = rng.choice(sorted(SECRET_CUES) + ["the", "with", "x"])
            before = f"{rng.choice(words)} {rng.choice([cue, cue.upper()])}{rng.choice([' = ', '=', ': ', ' '])}{quote}"
            out.append((f"{before}{secret}{quote}{rng.choice(['', ',', '.', ' ok'])}", {("secret", len(before), len(before) + len(secret))}))
        else:
            name = "".join(rng.choice(words) + str(rng.randrange(10 ** rng.choice([1, 2, 4, 8]))) for _ in range(rng.choice([2, 2, 3])))
            quote = rng.choice(["", "", "\""])
            out.append((f"{rng.choice(['the', 'see', 'of', 'file', 'key'])}{rng.choice([' ', ' = ', ': '])}{quote}{name}{quote} is", set()))
    return out


def _training_windows(docs: DataFrame, fit: Fit, id_col: str, text_col: str) -> list[tuple[str, int, int]]:
    chosen = docs.select(F.col(id_col).alias("id")).where("id is not null").orderBy(F.xxhash64("id"), "id").limit(fit.texts).distinct()
    texts = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text")).join(F.broadcast(chosen), "id").select("text")  # fit.texts ids at most

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            rows = []
            for text in block.column("text").to_pylist():
                for a, b in list(windows(text))[: fit.windows_a_text]:
                    if b - a <= 400:
                        near = max(0, a - 24)
                        rows.append((text[near : b + 8], a - near, b - near))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["near", "a", "b"])

    rows = texts.mapInArrow(take, "near string, a long, b long").orderBy(F.xxhash64("near"), "near").limit(fit.windows).collect()
    return [(r["near"], r["a"], r["b"]) for r in rows]


def learn(docs: DataFrame, fit: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Weights fitted on the sample and the made-up examples.

    Windows in which a pattern matched but failed its check, or in which matches overlap, are not used: what is
    true there is just what the patterns cannot say.
    """
    return learn_from(_training_windows(docs, fit, id_col, text_col), fit)


def learn_from(taken: list[tuple[str, int, int]], fit: Fit = Fit()) -> Field:
    examples = [(t, 0, len(t)) for t in EXAMPLES] + taken
    data = [(lattice(text, a, b), gold) for text, gold in made_up_secrets(fit.made_up, 1) for a, b in windows(text)]
    for text, a, b in examples:
        if (text, a, b) not in examples[: len(EXAMPLES)] and re.search(MIXED, text[a:b]):
            continue  # what it is, the patterns do not say
        gold = [s for s in base_spans(text) if a <= s[1] and s[2] <= b]
        failed = [m.group() for kind in KINDS[1:] for m in PATTERNS[kind].finditer(text, a, b) if not valid(kind, m.group())]
        missed = any(sum(map(len, DIGITS.findall(x))) >= 9 for x in failed)
        ends = sorted((s, e) for _, s, e in gold)
        if (missed and (text, a, b) not in examples[: len(EXAMPLES)]) or any(e > s for (_, e), (s, _) in zip(ends, ends[1:], strict=False)):
            continue
        data.append((lattice(text, a, b), set(gold)))
    model, squares = Field(), {}
    order = random.Random(0)
    for _ in range(fit.passes):
        order.shuffle(data)
        for graph, gold in data:
            for key, g in model.gradient(graph, gold).items():
                g -= fit.decay * model.weights.get(key, 0.0)
                squares[key] = squares.get(key, 1e-8) + g * g
                model.weights[key] = model.weights.get(key, 0.0) + fit.rate * g / math.sqrt(squares[key])
    return model


def added_spans(text: str, base: list[Span], model: Field) -> list[Span]:
    """Segments of the best cuts that pass their kind's check and touch no match of the patterns."""
    taken = sorted((s, e) for _, s, e in base)
    out = []
    for a, b in windows(text):
        if any(s <= a and b <= e for s, e in taken):
            continue
        graph = lattice(text, a, b)
        if graph.segments:
            out += [x for x in model.best(graph) if valid(x[0], text[x[1] : x[2]]) and not any(s < x[2] and x[1] < e for s, e in taken)]
    return out


def spans_of(text: str, model: Field) -> tuple[list[Span], list[Span]]:
    """The patterns' spans, and these with what the field adds; by kind, then start."""
    base = base_spans(text)
    more = added_spans(text, base, model)
    return base, sorted(base + more, key=lambda s: (TYPES.index(s[0]), s[1], s[2]))


def found(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, base, spans`` (arrays of kind, start, end) for every row, ends exclusive, in code points.

    Null and empty texts have no spans; repeated rows and null ids keep a row each; no rows give no rows; other columns
    are not read.
    """
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = lambda spans: [dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans]
        for block in blocks(batches, "text"):
            both = [spans_of(t, model) for t in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column(0), *[pa.array([named(x[k]) for x in both], span) for k in (0, 1)]], names=["id", "base", "spans"])

    kind = "array<struct<kind:string,start:bigint,end:bigint>>"
    return docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text")).mapInArrow(find, f"id long, base {kind}, spans {kind}")
