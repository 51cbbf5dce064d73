"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans: e-mail addresses, IP addresses, payment cards, telephone numbers. The field
then labels every token that holds a digit or an at sign (others cannot be part of these kinds). Its
potentials are those of a token's own form, of neighbouring tokens (a chain), and of distant tokens of one
document that are the same or alike (skips): same text, same last digits, same part before an at sign. A
token is linked to the next one like it, so a thing named a thousand times is a path, not a million pairs.
Tokens in base spans are observed. Loopy message passing carries labels along chain and skips until
a document's mentions agree; tokens that are no base span but labelled with a kind become added spans.

The field is trained here, without labels but the base spans of the corpus: token patterns (form,
neighbours' labels, linked tokens' kinds) are counted over all documents, and the weights maximise the
pseudo-likelihood of the most frequent ``FIT_PATTERNS`` of them. The texts are read twice and not shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm import text as T

KINDS = ["email", "ip", "card", "phone"]
#: Labels of tokens: nothing, or a kind and whether the token begins a span. The first two kinds are one token.
LABELS = ["-", "email", "ip", "card", "card+", "phone", "phone+"]
_KIND_OF = np.array([0, 1, 2, 3, 3, 4, 4])
_BEGINS = {"email": 1, "ip": 2, "card": 3, "phone": 5}
#: Bound of the fit: so many distinct token patterns at most, the most frequent ones of the whole corpus.
FIT_PATTERNS = 20_000
FIT_STEPS, DECAY = 400, 1e-3
#: Rounds of messages, share of the old message that stays, and the least probability of an added label.
ROUNDS, DAMPING, SURE = 16, 0.3, 0.5

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_DIAL = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
#: Starts only where a token starts, so a long text without digits is passed once.
_TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


# base spans


def luhn(digits: str) -> bool:
    total = 0
    for i, char in enumerate(reversed(digits)):
        value = int(char) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def is_octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _emails(text: str) -> Iterator[tuple[int, int, bool]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done, True
        else:
            done = max(done, at)
        at = text.find("@", max(at + 1, done))


def _addresses(text: str) -> Iterator[tuple[int, int, bool]]:
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        at, parts = run.start(), run.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            yield at, at + size, all(map(is_octet, four))
            at += size + 1


def _numbers(text: str, pattern: re.Pattern, least: int, most: int, check=None) -> Iterator[tuple[int, int, bool]]:
    for found in pattern.finditer(text):
        digits = _NOT_DIGIT.sub("", found.group())
        yield found.start(), found.end(), least <= len(digits) <= most and (check is None or check(digits))


def matches(text: str) -> list[tuple[str, int, int, bool]]:
    """All pattern matches as (kind, start, end, whether it passes its check), kind by kind, in linear time."""
    if not _ANY.search(text):
        return []
    found = {
        "email": _emails(text),
        "ip": _addresses(text),
        "card": _numbers(text, _DIGITS, 12, 19, luhn),
        "phone": _numbers(text, _DIAL, 9, 15),
    }
    return [(kind, *hit) for kind in KINDS for hit in found[kind]]


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in code points, end exclusive, by start, then kind as listed."""
    return sorted((hit[:3] for hit in matches(text) if hit[3]), key=in_order)


def in_order(span: Span) -> tuple:
    return span[1], KINDS.index(span[0]), span[2]


# tokens of a document


def shape(core: str) -> str:
    if "@" in core:
        local, _, rest = core.partition("@")
        return "email" if local and _DOMAIN.fullmatch(rest) else "at"
    marks = frozenset(core) - frozenset("0123456789")
    if not marks:
        return "digits"
    if marks == {"."}:
        return "dots4" if core.count(".") == 3 else "dots"
    if marks == {"-"}:
        return "hyphens"
    if marks == {"+"}:
        return "plus" if core[0] == "+" else "sum"
    if marks <= {"(", ")"}:
        return "parens"
    if marks <= set("+().-"):
        return "dial" if core[0] in "+(" else "joined"
    letters = marks & _LOCAL
    return "mixed" if letters and not (marks - _LOCAL) else "other"


def _size(digits: int) -> str:
    for low, high in ((5, 6), (9, 11), (12, 15), (17, 19)):
        if low <= digits <= high:
            return str(low)
    return str(min(digits, 20))


@dataclass
class Tokens:
    """Candidate tokens of one or more documents, with links between them."""

    spans: list[tuple[int, int]] = field(default_factory=list)
    forms: list[tuple] = field(default_factory=list)
    #: Label of a token in a base span, -1 of one that is not, -2 of one in a match that fails as a whole.
    seen: list[int] = field(default_factory=list)
    #: Earlier token, later token: neighbours, same, alike.
    links: tuple[list, list, list] = field(default_factory=lambda: ([], [], []))

    def add(self, text: str, hits: list[tuple[str, int, int, bool]]) -> int:
        """Append the tokens of a text; gives their number."""
        first, known = len(self.spans), {}
        cores, leads, last_end = [], [], None
        shapes: list[str] = []
        joined: list[bool] = []
        for found in _TOKEN.finditer(text):
            raw, start = found.group(), found.start()
            left = 0
            while left < len(raw) and not (raw[left].isalnum() or raw[left] in "+("):
                left += 1
            right = len(raw)
            while right > left and not (raw[right - 1].isalnum() or raw[right - 1] == ")"):
                right -= 1
            if left == right:
                left, right = 0, len(raw)
            core = raw[left:right]
            self.spans.append((start + left, start + right))
            cores.append(core)
            leads.append("" if left == 0 else "q" if raw[left - 1] in "\"'`" else "p")
            shapes.append(shape(core))
            joined.append(last_end is not None and left == 0 and not text[last_end:start].strip(" "))
            last_end = start + right if right == len(raw) else None
        self.seen += _labels(self.spans[first:], hits)
        for i, core in enumerate(cores):
            digits = _NOT_DIGIT.sub("", core)
            check = "l" if shapes[i] != "dots4" and 12 <= len(digits) <= 19 and luhn(digits) else ""
            if shapes[i] == "dots4" and all(map(is_octet, core.split("."))):
                check = "o"
            before = shapes[i - 1] if joined[i] else ""
            after = shapes[i + 1] if i + 1 < len(cores) and joined[i + 1] else ""
            self.forms.append((shapes[i], _size(len(digits)), check, leads[i], before, after))
            if joined[i]:
                self.links[0].append((first + i - 1, first + i))
            keys = [(1, core.lower())] if len(core) >= 4 else []
            if len(digits) >= 7:
                keys.append((2, digits[-7:]))
            local = core.partition("@")[0].lower()
            if len(local) >= 5:
                keys.append((2, local))
            linked = set()  # a token links once to another, as the same rather than as alike
            for key in keys:
                other = known.get(key)
                if other is not None and other not in linked and other != first + i:
                    self.links[key[0]].append((other, first + i))
                    linked.add(other)
                known[key] = first + i
        return len(cores)


def _labels(spans: list[tuple[int, int]], hits: list[tuple[str, int, int, bool]]) -> list[int]:
    out = [-1] * len(spans)
    starts = np.array([s for s, _ in spans], dtype=np.int64)
    ends = np.array([e for _, e in spans], dtype=np.int64)
    for kind, start, end, passed in sorted(hits, key=lambda hit: not hit[3]):
        low = int(np.searchsorted(ends, start, side="right"))
        high = int(np.searchsorted(starts, end, side="left"))
        for i in range(low, high):
            if out[i] == -1 and passed:
                out[i] = _BEGINS[kind] + (i > low and kind in ("card", "phone"))
            elif out[i] == -1 and high - low > 1:
                out[i] = -2
    return out


# the field


def _features(form: Sequence[str]) -> list[str]:
    what, size, check, lead, before, after = form
    return [
        "", f"s{what}", f"z{what} {size}", f"c{what} {size} {check}", f"p{what} {lead}",
        f"b{before} {what}", f"a{what} {after}", f"n{before} {what} {size} {after}",
    ]


@dataclass(frozen=True)
class Field:
    weights: dict[str, np.ndarray]
    #: Potentials of two labels: neighbours (earlier, later), same, alike.
    pairs: np.ndarray

    def own(self, forms: Sequence[Sequence[str]]) -> np.ndarray:
        out = np.zeros((len(forms), len(LABELS)))
        cache: dict[tuple, np.ndarray] = {}
        for i, form in enumerate(forms):
            form = tuple(form)
            if form not in cache:
                found = [self.weights[f] for f in _features(form) if f in self.weights]
                cache[form] = np.sum(found, axis=0) if found else np.zeros(len(LABELS))
            out[i] = cache[form]
        return out


def patterns_of(tokens: Tokens) -> Counter:
    """Number of tokens by (form, labels of neighbours, kinds of linked tokens, own label) as text."""
    seen = tokens.seen
    around: list[list[str]] = [[] for _ in seen]
    for kind, links in enumerate(tokens.links):
        for a, b in links:
            if seen[a] != -2 and seen[b] != -2:
                la, lb = max(seen[a], 0), max(seen[b], 0)
                if kind:
                    la, lb = int(_KIND_OF[la]), int(_KIND_OF[lb])
                around[a].append(f"{kind}>{lb}")
                around[b].append(f"{kind}<{la}")
    out: Counter = Counter()
    for form, others, label in zip(tokens.forms, around, seen, strict=True):
        if label != -2:
            out["|".join(form) + ";" + ",".join(sorted(others)) + ";" + str(max(label, 0))] += 1
    return out


def fit_patterns(counted: Sequence[tuple[str, int]], steps: int = FIT_STEPS, decay: float = DECAY) -> Field:
    """Weights of the largest penalised pseudo-likelihood of (pattern, count) rows, by gradient ascent.

    Counts weigh by their square roots, so that the commonest patterns do not drown the rest. No rows give
    a field without weights, which adds nothing.
    """
    counted = sorted(counted)
    names: dict[str, int] = {}
    rows, chains, skips, labels = [], [], [], []
    for text, _ in counted:
        form, around, label = text.split(";")
        rows.append([names.setdefault(f, len(names)) for f in _features(form.split("|"))])
        others = [(o[0], o[1], int(o[2:])) for o in around.split(",") if o]
        chain, skip = np.zeros((2, len(LABELS))), np.zeros((2, len(KINDS) + 1))
        for kind, way, other in others:
            if kind == "0":
                chain[0 if way == "<" else 1, other] += 1
            else:
                skip[int(kind) - 1, other] += 1
        chains.append(chain)
        skips.append(skip)
        labels.append(int(label))
    many, kinds = len(LABELS), len(KINDS) + 1
    if not rows:
        return Field({}, np.zeros((3, many, many)))
    rows, chains, skips = np.array(rows), np.array(chains), np.array(skips)
    share = np.sqrt([n for _, n in counted])
    share /= share.sum()
    wanted = np.eye(many)[labels]
    in_kind = np.eye(kinds)[_KIND_OF]  # label to kind
    parts = [np.zeros((len(names), many)), np.zeros((many, many)), np.zeros((2, kinds, kinds))]
    mean, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, steps + 1):
        own, chain, skip = parts
        both = skip + skip.transpose(0, 2, 1)  # a skip has no direction
        logits = own[rows].sum(axis=1) + chains[:, 0] @ chain + chains[:, 1] @ chain.T
        logits += np.einsum("nte,tek->nk", skips, both) @ in_kind.T
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        miss = (wanted - p) * share[:, None]
        g_own = np.zeros_like(own)
        np.add.at(g_own, rows, miss[:, None, :])
        g_chain = chains[:, 0].T @ miss + miss.T @ chains[:, 1]
        g_skip = np.einsum("nte,nk->tek", skips, miss @ in_kind)
        g_skip = g_skip + g_skip.transpose(0, 2, 1)
        for i, g in enumerate((g_own, g_chain, g_skip)):  # Adam's steps
            g = g - decay * share.mean() * parts[i]
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g * g
            parts[i] = parts[i] + 0.05 * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-9)
    own, chain, skip = parts
    both = skip + skip.transpose(0, 2, 1)
    pairs = np.stack([chain, *(in_kind @ both[t] @ in_kind.T for t in (0, 1))])
    return Field({name: own[i] for name, i in names.items()}, pairs)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def beliefs(own: np.ndarray, links: Sequence[Sequence[tuple[int, int]]], pairs: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Log marginals of every token's labels after ``rounds`` of messages along all links at once.

    Exact where links form no loop and paths are no longer than ``rounds``; approximate elsewhere.
    """
    edges = [(a, b, kind) for kind, found in enumerate(links) for a, b in found]
    belief = own.copy()
    if edges:
        a, b, kind = np.array(edges, dtype=np.int64).T
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        potential = np.concatenate([pairs[kind], pairs[kind].transpose(0, 2, 1)])
        sent = np.zeros((len(source), own.shape[1]))
        for _ in range(rounds):
            new = _log_sum(potential + (belief[source] - sent[back])[:, :, None], axis=1)
            new -= new.max(axis=1, keepdims=True)
            sent = DAMPING * sent + (1 - DAMPING) * new
            belief = own.copy()
            np.add.at(belief, target, sent)
    return belief - _log_sum(belief, axis=1)[:, None]


def label(tokens: Tokens, model: Field, rounds: int = ROUNDS, sure: float = SURE) -> list[int]:
    """Most likely label of every token; tokens of base spans keep theirs."""
    if not tokens.spans or not model.weights:
        return [max(s, 0) for s in tokens.seen]
    own = model.own(tokens.forms)
    seen = np.array(tokens.seen)
    held = np.flatnonzero(seen > 0)
    own[held] = -1e6
    own[held, seen[held]] = 0.0
    marginal = beliefs(own, tokens.links, model.pairs, rounds)
    best = marginal.argmax(axis=1)
    best[marginal.max(axis=1) < np.log(sure)] = 0
    best[held] = seen[held]
    return best.tolist()


def added_spans(tokens: Tokens, labels: list[int], first: int, count: int) -> list[Span]:
    """Spans that labels make of tokens outside base spans; a tail after a base span's tokens is no span."""
    out: list[Span] = []
    joined = {b for _, b in tokens.links[0]}
    open_kind, from_base = 0, False
    for i in range(first, first + count):
        kind = int(_KIND_OF[labels[i]])
        goes_on = LABELS[labels[i]].endswith("+") and i in joined and kind == open_kind
        base = tokens.seen[i] > 0
        if kind and not base:
            start, end = tokens.spans[i]
            if not goes_on:
                out.append((KINDS[kind - 1], start, end))
            elif not from_base:
                out[-1] = (out[-1][0], out[-1][1], end)
        from_base = base or (goes_on and from_base)
        open_kind = kind
    return out


def apart(spans: list[Span], base: list[Span]) -> list[Span]:
    """Those of ``spans`` that overlap none of ``base``."""
    ends = [(s, 1) for _, s, _ in base] + [(e, -1) for _, _, e in base]
    ends.sort()
    at, depth = [e for e, _ in ends], [0, *np.cumsum([step for _, step in ends]).tolist()]
    out = []
    for span in spans:
        low, high = bisect_right(at, span[1]), bisect_left(at, span[2])
        if not any(depth[low : high + 1]):
            out.append(span)
    return out


# Spark


def _read(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of groups of rows of bounded size (or one longer row)."""
    data, offsets = T.texts(column)
    for first, last in T.slices(offsets):
        raw = [data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace") for i in range(first, last)]
        yield first, raw


def count_patterns(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """pattern, n over all documents, added up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["pattern", "n"])

        for batch in batches:
            for _, texts in _read(batch.column("text")):
                for text in texts:
                    if _ANY.search(text):
                        tokens = Tokens()
                        tokens.add(text, matches(text))
                        total.update(patterns_of(tokens))
            if len(total) > 100_000:
                yield rows()
                total.clear()
        yield rows()

    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "pattern string, n bigint").groupBy("pattern").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, fit_patterns_: int = FIT_PATTERNS) -> Field:
    """The field of the base spans of all documents; reads column text only."""
    top = count_patterns(docs).orderBy(F.desc("n"), "pattern").limit(fit_patterns_)
    return fit_patterns([(r["pattern"], r["n"]) for r in top.collect()])


def personal_data(docs: DataFrame, model: Field, carry: Sequence[str | Column] = ()) -> DataFrame:
    """Per row: doc_id and spans, an array of (kind, start, end, base) by start, then kind as listed.

    Places are code points, end exclusive. Base spans are always there; added ones overlap none of them.
    Null and empty texts have no spans. Rows stay one to one, repeated and null ids too, and equal texts get
    equal spans; other columns are ignored, or come out in the struct ``carried``. A document's tokens are
    labelled together whatever its length.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", *(["carried"] if carry else [])]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _read(batch.column("text")):
                tokens, places, based = Tokens(), [], []
                for text in texts:
                    hits = matches(text)
                    based.append([hit[:3] for hit in hits if hit[3]])
                    places.append((len(tokens.spans), tokens.add(text, hits) if _ANY.search(text) else 0))
                labels = label(tokens, shared.value)
                out = []
                for base, (at, count) in zip(based, places, strict=True):
                    more = apart(added_spans(tokens, labels, at, count), base)
                    rows = [(*s, True) for s in base] + [(*s, False) for s in more]
                    out.append([dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in sorted(rows, key=in_order)])
                columns = [batch.column(name).slice(first, len(texts)) for name in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(out, kind)], [*names, "spans"])

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    )
    kinds = [f"{name} {rows.schema[name].dataType.simpleString()}" for name in names]
    return rows.mapInArrow(run, ", ".join([*kinds, "spans array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"]))


def written_out(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
