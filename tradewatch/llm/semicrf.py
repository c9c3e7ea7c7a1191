"""Personal data as spans: patterns first, then a semi-Markov conditional random field for what the patterns lose.

Base spans are the leftmost matches of one pattern per kind that pass the kind's test (octets, Luhn sum, digits). They stay.
Where a greedy match fails its test, as a card number with another number behind it, the parts are lost. There a
semi-Markov field scores whole segments: a candidate is a run of tokens that could be of a kind, as long as the kind can be (a
card typed digit by digit has 37 tokens), and its score adds weights of features of the whole span (its test, its length, its separators, what stands around it). Boundaries
and kinds are chosen together by dynamic programming over the segments that may end at each token; tokens outside of
segments score zero. Spans it finds are added where they do not touch base spans of their kind.

The weights are learned by the likelihood of the base spans in all regions of all documents where every match passes its test.
Candidates of a region that share no token, also not through others, are independent, so a lesson is a group of candidates
that do. It depends on no text, only on how the candidates overlap and on what is seen of them. Spark counts equal lessons, and
Newton's method climbs the mean penalised likelihood: in each round tasks add up value, gradient and curvature over
the counted lessons, so neither the driver nor a task holds all of them. The function is concave: the weights do not depend on
the order of rows. Without any lesson nothing is added.

Null texts are empty and have no span. Repeated rows are judged alone. Texts of any length are read whole. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import ROW, carried, schema_of, stored

KINDS = ("email", "ip", "card", "phone")
# fixed values: the base patterns
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: A run of digits is tried from its start only; later starts in it cannot match where the first does not.
_IP = re.compile("(?<![0-9])" + PATTERNS["ip"].pattern)
#: What may part the digits of a kind, and the least and most digits it has.
DIGITS = {"card": (" -", 14, 19), "phone": (" ().-", 10, 15)}
#: Longer addresses are no candidates. None is lost by that: every match of the pattern is a base span.
EMAIL_TOKENS = 24
CONTEXT = 24
#: Where learning is asked to be bounded: at most this many regions of a document, of at most so many characters.
TRAIN_REGIONS, TRAIN_CHARS = 10, 1000
#: Weight of the squared weights, the gain of mean likelihood below which learning ends, and its rounds at most.
PENALTY, LEAST_GAIN, ROUNDS = 1e-3, 1e-7, 50
#: Distinct lessons a task holds before it hands on their counts.
HELD_LESSONS = 20_000
#: A document that does not match has no base span of the kind.
_MAY_HOLD = {
    "email": "@[A-Za-z0-9-]+[.]",
    "ip": "[0-9][.][0-9]+[.][0-9]+[.][0-9]",
    "card": "[0-9]([ -]?[0-9]){13}",
    "phone": "[+][0-9][ ().0-9-]{8,}[0-9]",
}
_MARK = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")
_NAME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, x in enumerate(reversed(digits)):
        x = int(x) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def holds(kind: str, span: str) -> bool:
    """The test that a match of the kind's pattern has to pass."""
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in span.split("."))
    digits = re.sub(r"[^0-9]", "", span)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15


def _matches(kind: str, text: str):
    if kind != "email":
        return [m.span() for m in (_IP if kind == "ip" else PATTERNS[kind]).finditer(text)]
    out, end = [], 0
    at = text.find("@")
    while at >= 0:  # from each @ back over the name: the pattern itself would try every place of a long name
        start = at
        while start > end and text[start - 1] in _NAME:
            start -= 1
        found = PATTERNS["email"].match(text, start) if start < at else None
        if found:
            out.append(found.span())
            end = found.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """(kind, start, end) of all base spans, and the (start, end) of matches that fail their test."""
    spans, failed = [], []
    kinds = [k for k in KINDS if k == "email" and "@" in text or k == "phone" and "+" in text or k in ("ip", "card")]
    for kind in kinds if _MARK.search(text) else ():
        for a, b in _matches(kind, text):
            if holds(kind, text[a:b]):
                spans.append((kind, a, b))
            elif b - a > 8:
                failed.append((a, b))
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]))), failed


FEATURES = ("whole", "tokens", "cut_left", "cut_right", "joined_left", "joined_right", "mixed_marks", "regular", "cue")
CUES = {"email": ("mail", "@"), "ip": ("ip", "host", "addr"), "card": ("card", "visa", "pay"), "phone": ("tel", "phone", "call", "fax")}


def features(text: str, kind: str, a: int, b: int, tokens: int) -> np.ndarray:
    """What is seen of a whole candidate span; a row of ``FEATURES``."""
    span, left, right = text[a:b], text[a - 1 : a], text[b : b + 1]
    marks = set(re.sub(r"[A-Za-z0-9]", "", span)) - {"@", "+"}
    groups = [len(x) for x in re.findall(r"[0-9]+", span)]
    before = text[max(0, a - CONTEXT) : a].lower()
    return np.array(
        [
            1.0,
            tokens / EMAIL_TOKENS,
            left.isalnum(),
            right.isalnum(),
            bool(re.search(r"[0-9][\x20.-]$", text[max(0, a - 2) : a])),
            bool(re.match(r"[\x20.-][0-9]", text[b : b + 2])),
            len(marks) > (1 if kind != "phone" else 3),
            len(set(groups[:-1])) <= 1,
            any(x in before for x in CUES[kind]),
        ],
        float,
    )


def _digit_ends(text: str, places: list[tuple[int, int]], first: int, kind: str):
    """The tokens at which a card or phone that begins with token ``first`` may end: as many digits as the kind can have,
    however they are parted."""
    marks, least, most = DIGITS[kind]
    digits, parted = 0, False
    for j in range(first, len(places)):
        start, end = places[j]
        if "0" <= text[start] <= "9":
            digits, parted = digits + end - start, False
            if digits > most:
                return
            if digits >= least:
                yield j
        elif j > first and (text[start] not in marks or parted and kind == "card"):
            return
        else:
            parted = True


def candidates(text: str, a: int, b: int):
    """(first token, token behind, kind, start, end, features) of all segments of a region that could be of a kind."""
    places = [m.span() for m in _TOKEN.finditer(text, a, b)]
    ats = [k for k, (start, _) in enumerate(places) if text[start] == "@"]
    out = []

    def add(i: int, j: int, kind: str) -> None:
        start, end = places[i][0], places[j][1]
        span = text[start:end]
        if PATTERNS[kind].fullmatch(span) and holds(kind, span):
            out.append((i, j + 1, kind, start, end, features(text, kind, start, end, j + 1 - i)))

    for i, (start, _) in enumerate(places):
        if "0" <= text[start] <= "9":
            if i + 7 <= len(places):
                add(i, i + 6, "ip")
            for j in _digit_ends(text, places, i, "card"):
                add(i, j, "card")
        elif text[start] == "+":
            for j in _digit_ends(text, places, i, "phone"):
                add(i, j, "phone")
        at = bisect_left(ats, i + 1)
        if text[start] in _NAME and at < len(ats):
            for j in range(ats[at] + 1, min(len(places), i + EMAIL_TOKENS)):
                add(i, j, "email")
    return len(places), sorted(out, key=lambda x: (x[0], x[1], KINDS.index(x[2])))


def regions(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts of a text around given spans that share no characters of a pattern with the rest."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        while a > 0 and _inside(text[a - 1]) and not (text[a - 1] == " " and text[a - 2 : a - 1].isalpha()):
            a -= 1
        while b < len(text) and _inside(text[b]) and not (text[b] == " " and text[b + 1 : b + 2].isalpha()):
            b += 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _inside(char: str) -> bool:
    return char in _NAME or char in "@() "


def best_segments(n: int, found, weights: dict[str, np.ndarray]):
    """The segments of the highest total score, by dynamic programming over where segments end."""
    by_end: dict[int, list] = {}
    for x in found:
        by_end.setdefault(x[1], []).append(x)
    best, back = np.zeros(n + 1), [None] * (n + 1)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for x in by_end.get(j, ()):
            score = best[x[0]] + float(weights[x[2]] @ x[5])
            if score > best[j]:
                best[j], back[j] = score, x
    out, j = [], n
    while j > 0:
        if back[j] is None:
            j -= 1
        else:
            out.append(back[j])
            j = back[j][0]
    return out[::-1]


#: Numbers a lesson has of each candidate: where it begins and ends, kind, whether it is a base span, tokens, and the other
#: features as bits.
_NUMBERS = 6
_SIZE = len(KINDS) * len(FEATURES)


def groups(text: str, a: int, b: int, spans) -> list[bytes]:
    """The lessons of a region: its candidates, cut into groups that share no token, each as numbers. Places are
    numbered within the group, since only their order counts."""
    gold, out, own, end = {tuple(x) for x in spans}, [], [], 0

    def close() -> None:
        at = {x: k for k, x in enumerate(sorted({x for c in own for x in c[:2]}))}
        numbers = array("I")
        for i, j, kind, start, stop, seen in own:
            bits = sum(1 << k for k, x in enumerate(seen[2:].tolist()) if x)
            numbers.extend((at[i], at[j], KINDS.index(kind), (kind, start, stop) in gold, j - i, bits))
        out.append(numbers.tobytes())

    for x in candidates(text, a, b)[1]:
        if own and x[0] >= end:
            close()
            own, end = [], 0
        own.append(x)
        end = max(end, x[1])
    if own:
        close()
    return out


def moments(lesson: bytes, weights: np.ndarray):
    """(log-likelihood, gradient, covariance of what is seen, their places among all weights) of the base spans of a lesson.

    For each place, all segmentations up to it have a total, a mean and a mean square of the sum of what is seen in them.
    """
    rows = np.frombuffer(lesson, array("I").typecode).reshape(-1, _NUMBERS).astype(np.int64)
    every = np.zeros((len(rows), len(KINDS), len(FEATURES)))
    every[np.arange(len(rows)), rows[:, 2]] = np.column_stack(
        [np.ones(len(rows)), rows[:, 4] / EMAIL_TOKENS, rows[:, 5:] >> np.arange(len(FEATURES) - 2) & 1]
    )
    every = every.reshape(len(rows), _SIZE)
    places = np.flatnonzero(every.any(0))
    every = every[:, places]
    scores = every @ weights[places]
    by_end: dict[int, list[int]] = {}
    last: dict[int, int] = {}
    for k, (i, j) in enumerate(rows[:, :2].tolist()):
        by_end.setdefault(j, []).append(k)
        last[i] = max(last.get(i, 0), j)
    done: dict[int, list[int]] = {}
    state = {0: (0.0, np.zeros(len(places)), np.zeros((len(places), len(places))))}
    n = int(rows[:, 1].max())
    for i in range(n):
        done.setdefault(max(last.get(i, 0), i + 1), []).append(i)
    for j in range(1, n + 1):
        parts = [state[j - 1]]
        for k in by_end.get(j, ()):
            total, mean, square = state[int(rows[k, 0])]
            both = np.outer(every[k], mean)
            parts.append((total + scores[k], mean + every[k], square + both + both.T + np.outer(every[k], every[k])))
        total = float(np.logaddexp.reduce([x[0] for x in parts]))
        chances = [np.exp(x[0] - total) for x in parts]
        state[j] = (total, *(sum(c * x[m] for c, x in zip(chances, parts, strict=True)) for m in (1, 2)))
        for i in done.get(j, ()):  # no candidate begins there any more
            del state[i]
    total, mean, square = state[n]
    gold = rows[:, 3] > 0
    return float(scores[gold].sum()) - total, every[gold].sum(0) - mean, square - np.outer(mean, mean), places


def added_up(counted, weights: np.ndarray) -> np.ndarray:
    """Number, log-likelihood, gradient and covariance, in a row, of (lesson, how often) together."""
    n, value, slope, spread = 0, 0.0, np.zeros(_SIZE), np.zeros((_SIZE, _SIZE))
    for lesson, times in counted:
        own, step, square, places = moments(lesson, weights)
        n += times
        value += times * own
        slope[places] += times * step
        spread[np.ix_(places, places)] += times * square
    return np.concatenate([[n, value], slope, spread.ravel()])


def climbed(sums) -> dict[str, np.ndarray] | None:
    """Weights per kind with the highest mean penalised likelihood, by Newton's method; ``sums`` gives what ``added_up`` does
    for all lessons at given weights. None without any lesson."""

    def seen_from(weights: np.ndarray):
        found = sums(weights)
        n = max(1.0, found[0])
        spread = found[2 + _SIZE :].reshape(_SIZE, _SIZE) / n + PENALTY * np.eye(_SIZE)
        return found[0], found[1] / n - PENALTY / 2 * weights @ weights, found[2 : 2 + _SIZE] / n - PENALTY * weights, spread

    weights = np.zeros(_SIZE)
    n, value, slope, spread = seen_from(weights)
    if not n:
        return None
    for _ in range(ROUNDS):
        step = np.linalg.solve(spread, slope)
        gain = float(slope @ step)
        if gain < LEAST_GAIN:
            break
        n, there, slope, spread = seen_from(weights + step)
        while there < value + gain / 1000 and np.abs(step).max() > 1e-6:  # too far: half the way
            step, gain = step / 2, gain / 2
            n, there, slope, spread = seen_from(weights + step)
        weights, value = weights + step, there
    return {kind: own.copy() for kind, own in zip(KINDS, weights.reshape(len(KINDS), -1), strict=True)}


def lessons(text: str, bounded: bool = True) -> list[tuple[str, int, int, list[tuple[str, int, int]]]]:
    """(excerpt, begin, end, base spans) of the regions of a text in which every match passes its test; all of them, or a
    bounded number."""
    spans, failed = base_spans(text)
    lost = regions(text, failed)
    out, at = [], 0
    for a, b in regions(text, [(x, y) for _, x, y in spans]):
        while at < len(lost) and lost[at][1] <= a:
            at += 1
        if bounded and b - a > TRAIN_CHARS or at < len(lost) and lost[at][0] < b:
            continue
        left = max(0, a - CONTEXT)
        out.append((text[left : b + 2], a, b, left))
    every = -(-len(out) // TRAIN_REGIONS) if out and bounded else 1
    own = []
    for excerpt, a, b, left in out[::every]:
        low, high = bisect_left(spans, a, key=lambda x: x[1]), bisect_left(spans, b, key=lambda x: x[1])
        own.append((excerpt, a - left, b - left, [(k, x - left, y - left) for k, x, y in spans[low:high]]))
    return own


def counted_lessons(texts, bounded: bool = False) -> Counter:
    """The lessons of some texts and how often each occurs."""
    return Counter(x for text in texts for given in lessons(text or "", bounded) for x in groups(*given))


def train(texts: list[str]) -> dict[str, np.ndarray] | None:
    """Weights per kind, learned from all lessons of some texts; None without any."""
    counted = counted_lessons(texts)
    return climbed(lambda weights: added_up(counted.items(), weights))


def all_spans(text: str, weights: dict[str, np.ndarray] | None):
    """(base spans, all spans) of a text, both by start and then by kind."""
    base, failed = base_spans(text)
    added = []
    if weights and failed:
        for a, b in regions(text, failed):
            n, found = candidates(text, a, b)
            for _, _, kind, start, end, _ in best_segments(n, found, weights):
                if not any(k == kind and x < end and start < y for k, x, y in base):
                    added.append((kind, start, end))
    return base, sorted(base + added, key=lambda x: (x[1], KINDS.index(x[0])))


def written(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def masked(text: str, spans) -> str:
    """The text with each span replaced by its kind in angle brackets; spans that overlap become one, named by the first."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


_ARROW_LESSON = pa.schema([("lesson", pa.binary()), ("n", pa.int64())])
_ARROW_SUM = pa.schema([("place", pa.int32()), ("value", pa.float64())])


def _told(bounded: bool):
    def run(batches):
        held: Counter = Counter()

        def counts():
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], schema=_ARROW_LESSON)

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.update(counted_lessons([text], bounded))
                if len(held) >= HELD_LESSONS:
                    yield counts()
                    held.clear()
        yield counts()

    return run


def _summed(weights: np.ndarray):
    def run(batches):
        rows = ((x, n) for batch in batches for x, n in zip(batch.column("lesson").to_pylist(), batch.column("n").to_pylist(), strict=True))
        found = added_up(rows, weights)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(found[at])], schema=_ARROW_SUM)

    return run


def fit(docs: DataFrame, train_docs: int | None = None) -> dict[str, np.ndarray] | None:
    """The field's weights, learned from all documents. With ``train_docs`` from a bounded number of regions of about so many of
    them, a quarter for each kind that they may hold; no query asks for that."""
    if train_docs:
        docs = _some(docs, train_docs)
    told = docs.select("text").mapInArrow(_told(bool(train_docs)), "lesson binary, n long")
    counted = stored(told.groupBy("lesson").agg(F.sum("n").alias("n")), "lessons")

    def sums(weights: np.ndarray) -> np.ndarray:
        out = np.zeros(2 + _SIZE + _SIZE**2)
        parts = counted.mapInArrow(_summed(weights), "place int, value double")
        for place, value in parts.groupBy("place").agg(F.sum("value")).collect():
            out[place] = value
        return out

    return climbed(sums)


def _some(docs: DataFrame, train_docs: int) -> DataFrame:
    """About ``train_docs`` documents, a quarter for each kind that they may hold."""
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    may = {kind: F.coalesce(F.col("text").rlike(pattern), F.lit(False)) for kind, pattern in _MAY_HOLD.items()}
    n = docs.agg(*[F.count_if(x).alias(kind) for kind, x in may.items()]).first()
    each = max(1, train_docs // len(KINDS))
    limits = {kind: 1 << 30 if n[kind] <= each else int(0.95 * each / n[kind] * (1 << 30)) for kind in KINDS}
    chosen = F.lit(False)
    for kind, limit in limits.items():
        chosen |= may[kind] & (place < limit)
    return docs.where(chosen)


_COUNTS = [f"n_{kind}" for kind in KINDS]


def find_personal_data(docs: DataFrame, weights, with_text: bool = False, carry: bool = False) -> DataFrame:
    """doc_id, the base spans of each kind (counts), base_sha256, spans, n_added and, if asked for, ``masked`` and the row."""
    names = ["doc_id", *_COUNTS, "base_sha256", "spans", "n_added", *["masked"] * with_text]
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()] + [pa.string()] * with_text

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                base, spans = all_spans(text or "", weights)
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                row = (doc_id, *counts, digest, written(spans), len(spans) - len(base))
                out.append(row + ((None if text is None else masked(text, spans),) if with_text else ()))
            columns = list(zip(*out, strict=True)) or [[] for _ in names]
            arrays = [pa.array(x, t) for x, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays + [batch.column(x) for x in [ROW] * carry], names=names + [ROW] * carry)

    schema = "doc_id long, " + ", ".join(f"{x} long" for x in _COUNTS) + ", base_sha256 string, spans string, n_added long" + ", masked string" * with_text
    return carried(docs, ["doc_id", "text"], carry).mapInArrow(run, schema_of(schema, docs, carry))
