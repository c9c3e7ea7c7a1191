"""Language identification by one character language model per language, with interpolated Kneser-Ney smoothing.

A text's words (runs without white space, in lower case, those with a letter) are spelled between a start and an end
sign. A character depends on up to ``order - 1`` characters before it in its word. The longest sequences are counted over
all learned rows; shorter ones count in how many ways they are continued to the left (at a word's start, where there
is only one way, as often as they occur). Each order is discounted by its own D = n1 / (n1 + 2 n2) and interpolated with the
shorter one. Shares and weights are computed by Spark over all counted sequences and kept as a table of 64-bit hashes with a value
per language, sorted and cut into files of about ``part_rows`` rows (sorted hash arrays).

A text goes to the language with the lowest cross-entropy per character. ``score`` is the posterior of that language, at a
temperature fitted on labelled rows that the fitted models have not seen; ``accepted`` is false where the cross-entropy lies
more than ``FURTHEST`` spreads above the median of those rows of its language and length (calibrated rejection). Spreads are
1.4826 * median absolute deviation, so up to half of a band's rows may be junk, mislabelled or very long without moving the
limit at will.
Both are fitted on all of those rows: each task scores its own, and Spark counts them by language, length (quarters of an octave)
and cross-entropy (steps of 1/256 nat). Medians, bands and deviations are those of the counts, whose number does not grow with the rows.

The files lie in the shared folder and are handed to the executors as files of the job; neither the driver nor a task ever holds
more than one of them, whatever the size of the model. A task looks its distinct sequences up in one file after the other, so
predictions do not depend on ``part_rows``.

Texts that are null or have no letter are ``und`` with score 0, not accepted. Rows without language or id are not learned
from. With no learned language all is ``und``. Repeated rows count as often as they occur. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewatch.llm import tokens
from tradewatch.llm.common import ROW, carried, schema_of, stored

ORDER = 5
#: Rows of a model's file, which is what a task holds of the model at a time.
PART_ROWS = 1_000_000
#: Calibration counts rows at this many steps a nat, and lengths at this many steps an octave.
STEPS, LENGTHS = 256, 4
#: What the posterior's temperature may be.
TEMPERATURES = (0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0)
START, END = "\u0002", "\u0003"
UNKNOWN_CHARS = 1 << 12
#: Spreads above the median that are still accepted, the least spread (nats), and rows a band of lengths needs.
FURTHEST, LEAST_SPREAD, BAND_ROWS = 6.0, 0.05, 30
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
#: Distinct words a task holds before it hands on the counts of their sequences.
HELD_WORDS = 150_000
#: Characters of texts that are told apart at once.
HELD_CHARS = 1 << 22
#: Distinct words whose sequences are looked up at once.
ASKED_WORDS = 50_000


def fold(doc_id="doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4))


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().replace(START, " ").replace(END, " ").split()


def has_letter(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


def _codes(words: list[str]):
    """Code points of all words between the signs, the end of each word's part, and the place in the word of each."""
    points = np.frombuffer("".join([START + w + END for w in words]).encode("utf-32-le", "replace"), "<u4")
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    first = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    return points, owner, np.arange(len(points)) - first[owner]


def _windows(points: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """The hash of the ``length`` characters that end at each place; where the word has fewer, of those it has."""
    out = np.zeros(len(points), np.uint64)
    with np.errstate(over="ignore"):
        for back in range(length - 1, -1, -1):
            there = place >= back
            value = np.zeros(len(points), np.uint64)
            value[back:] = points[: len(points) - back]
            out = np.where(there, (out ^ (value + np.uint64(1))) * _MULTIPLY, out)
            out = np.where(there, out ^ (out >> np.uint64(29)), out)
    return out


def hash_of(sequence: str) -> int:
    points = np.frombuffer(sequence.encode("utf-32-le", "replace"), "<u4")
    return int(_windows(points, np.arange(len(points)), len(points))[-1]) if len(points) else 0


def _sequences(words: Counter, order: int) -> tuple[list[str], np.ndarray]:
    """Distinct longest sequences of the words with their counts; the last character is the one that is predicted."""
    listed = list(words)
    points, owner, place = _codes(listed)
    weight = np.fromiter(words.values(), np.int64, len(words))[owner]
    keys = _windows(points, place, order)
    at = np.flatnonzero(place > 0)
    _, first, inverse = np.unique(keys[at], return_index=True, return_inverse=True)
    counts = np.bincount(inverse, weight[at]).astype(np.int64)
    text = "".join([START + w + END for w in listed])
    ends = at[first] + 1
    begins = ends - np.minimum(order, place[at[first]] + 1)
    return [text[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], counts


def sequence_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, seen (whether for calibration's models as well), sequence, n over all rows of ``docs`` (text, lang, seen)."""
    schema = pa.schema([("lang", pa.string()), ("seen", pa.bool_()), ("sequence", pa.string()), ("n", pa.int64())])

    def run(batches):
        held: dict[tuple[str, bool], Counter] = {}
        tokens.forget()

        def handed():
            for (lang, seen), words in held.items():
                sequences, counts = _sequences(Counter({w: n for w, n in words.items() if has_letter(w)}), order)
                columns = [[lang] * len(sequences), [seen] * len(sequences), sequences, counts]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, schema.types, strict=True)], schema=schema)
            held.clear()

        for batch in batches:
            for text, lang, seen in zip(*[batch.column(x).to_pylist() for x in ("text", "lang", "seen")], strict=True):
                held.setdefault((lang, seen), Counter()).update(words_of(text))
                if sum(map(len, held.values())) > HELD_WORDS:
                    yield from handed()
        yield from handed()
        _let_go()

    counted = docs.select("text", "lang", "seen").mapInArrow(run, "lang string, seen boolean, sequence string, n long")
    return counted.groupBy("lang", "seen", "sequence").agg(F.sum("n").alias("n"))


def _hashes(strings: list[str]) -> np.ndarray:
    """``hash_of`` of each string."""
    points = np.frombuffer("".join(strings).encode("utf-32-le", "replace"), "<u4")
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    last, out = np.cumsum(sizes) - 1, np.zeros(len(strings), np.uint64)
    for length in np.unique(sizes).tolist():
        own = sizes == length
        out[own] = _around(points, last[own], length)
    return out


def smoothed(counts: DataFrame, langs: list[str]) -> DataFrame:
    """early, sequence, shares, backs: per language (in the order of ``langs``) the discounted share of a sequence (0 where it
    does not occur) and the weight of the shorter context behind it as a context (1 where it is none).

    ``counts`` has lang, seen, sequence, n; ``early`` rows are the model of what is ``seen``, the others that of everything.
    """
    lang = (F.array_position(F.array(*map(F.lit, langs)), F.col("lang")) - 1).cast("int")
    rows = counts.select(F.explode(F.when(F.col("seen"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))).alias("early"), lang.alias("lang"), "sequence", "n")
    size = F.length("sequence")
    cut = rows.select("early", "lang", "sequence", "n", F.explode(F.sequence(F.lit(2), size)).alias("size"))
    whole = F.when(F.col("size") == size, F.col("n")).otherwise(0)
    ends = cut.select("early", "lang", F.expr("right(sequence, size)").alias("sequence"), whole.alias("n")).groupBy("early", "lang", "sequence").agg(F.sum("n").alias("n"))
    # each distinct sequence is one way in which the shorter one is continued to the left; whole ones count as often as they occur
    either = F.array(F.struct("sequence", "n"), F.struct(F.expr("substring(sequence, 2)").alias("sequence"), F.lit(1).cast("long").alias("n")))
    valued = ends.select("early", "lang", F.inline(either)).groupBy("early", "lang", "sequence").agg(F.sum("n").alias("value")).where("value > 0")
    valued = stored(valued.withColumn("size", F.length("sequence")), "language-values")
    # one row per model, language and length
    levels = valued.groupBy("early", "lang", "size").agg(F.count_if(F.col("value") == 1).alias("once"), F.count_if(F.col("value") == 2).alias("twice"))
    discount = F.when(F.col("once") > 0, F.col("once") / (F.col("once") + 2 * F.col("twice"))).otherwise(0.5)
    levels = levels.select("early", "lang", "size", discount.alias("discount"))
    # a context has at most as many rows as there are characters
    same = Window.partitionBy("early", "lang", "context")
    shared = (
        valued.join(F.broadcast(levels), ["early", "lang", "size"])
        .withColumn("context", F.expr("left(sequence, size - 1)"))
        .withColumn("total", F.sum("value").over(same))
        .withColumn("kinds", F.count(F.lit(1)).over(same))
        .withColumn("first", F.row_number().over(same.orderBy("sequence")) == 1)
    )
    share = F.struct("sequence", (F.greatest(F.col("value") - F.col("discount"), F.lit(0.0)) / F.col("total")).alias("share"), F.lit(None).cast("double").alias("back"))
    back = F.struct(F.col("context").alias("sequence"), F.lit(None).cast("double").alias("share"), (F.col("discount") * F.col("kinds") / F.col("total")).alias("back"))
    both = shared.select("early", "lang", F.inline(F.when(F.col("first"), F.array(share, back)).otherwise(F.array(share))))

    def by_lang(name, missing):
        own = [F.coalesce(F.max(F.when(F.col("lang") == k, F.col(name))), F.lit(missing)).cast("float") for k in range(len(langs))]
        return F.array(*own).alias(f"{name}s")

    return both.groupBy("early", "sequence").agg(by_lang("share", 0.0), by_lang("back", 1.0))


def hashed(rows: DataFrame) -> DataFrame:
    """early, hash, shares, backs."""

    def run(batches):
        for batch in batches:
            hashes = _hashes(batch.column("sequence").to_pylist()).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("early"), pa.array(hashes), batch.column("shares"), batch.column("backs")], ["early", "hash", "shares", "backs"])

    return rows.mapInArrow(run, "early boolean, hash long, shares array<float>, backs array<float>")


def _files(spark: SparkSession, rows: DataFrame, part_rows: int) -> list[str]:
    """The model as sorted files of about ``part_rows`` rows that every executor can open."""
    parts = max(1, -(-rows.count() // part_rows))
    kept = stored(rows.select("hash", "shares", "backs").repartitionByRange(parts, "hash").sortWithinPartitions("hash"), "language-model")
    names = sorted(kept.inputFiles())
    for name in names:
        spark.sparkContext.addFile(name)
    return [name.rsplit("/", 1)[1] for name in names]


#: The file that was opened last; a model of one file is read once per task.
_opened: dict[str, tuple] = {}


def _let_go() -> None:
    """Free what a task has held: its worker process stays, beside those of other stages' tasks."""
    _opened.clear()
    pa.default_memory_pool().release_unused()


def _part(name: str, langs: int):
    """The hashes of a file, ascending, and its shares and backs by language."""
    if name not in _opened:
        _opened.clear()
        rows = pq.read_table(SparkFiles.get(name), use_threads=False).combine_chunks()
        tables = [rows.column(x).combine_chunks().flatten().to_numpy().reshape(-1, langs) for x in ("shares", "backs")]
        _opened[name] = (rows.column("hash").to_numpy(), *tables)
    return _opened[name]


class Models:
    """The languages and the files with, per language, the discounted share of a sequence and the weight of the shorter context."""

    def __init__(self, langs: list[str], files: list[str], order: int = ORDER):
        self.langs, self.files, self.order = langs, files, order

    def _found(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares and backs of ascending keys, one file after the other."""
        shares = np.zeros((len(keys), len(self.langs)), np.float32)
        backs = np.ones((len(keys), len(self.langs)), np.float32)
        for name in self.files:
            hashes, own_shares, own_backs = _part(name, len(self.langs))
            if not len(hashes):
                continue
            low, high = np.searchsorted(keys, hashes[0]), np.searchsorted(keys, hashes[-1], side="right")
            at = np.searchsorted(hashes, keys[low:high])
            there = np.flatnonzero(hashes[at] == keys[low:high])
            shares[low + there], backs[low + there] = own_shares[at[there]], own_backs[at[there]]
        return shares, backs

    def word_bits(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy of each word by language (nats, summed over its characters and its end), and how many they are."""
        points, owner, place = _codes(words)
        at = np.flatnonzero(place > 0)
        _, first, inverse = np.unique(_windows(points, place, self.order)[at], return_index=True, return_inverse=True)
        ends = at[first]
        # what is asked for: each distinct sequence once, with all its shorter forms and their contexts
        longer = [np.flatnonzero(place[ends] + 1 >= length) for length in range(1, self.order + 1)]
        asked = [_around(points, ends[x] - back, length - back) for length, x in enumerate(longer, 1) for back in (0, 1)]
        keys, where = np.unique(np.concatenate(asked).view(np.int64), return_inverse=True)
        shares, backs = self._found(keys)
        parts = np.split(where, np.cumsum([len(x) for x in asked])[:-1])
        chance = np.full((len(ends), len(self.langs)), 1.0 / UNKNOWN_CHARS)
        for x, whole, context in zip(longer, parts[::2], parts[1::2], strict=True):
            chance[x] = shares[whole] + backs[context] * chance[x]
        nats = -np.log(chance)[inverse]
        out = np.zeros((len(words), len(self.langs)))
        begins = np.flatnonzero(np.concatenate([[True], owner[at][1:] != owner[at][:-1]]))
        out[owner[at][begins]] = np.add.reduceat(nats, begins, axis=0)
        return out, np.bincount(owner[at], minlength=len(words))

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text by language, and its characters (0: no letter)."""
        parts, first, held = [], 0, 0
        for k, text in enumerate(texts):
            held += len(text or "")
            if held >= HELD_CHARS or k == len(texts) - 1:
                parts.append(self._texts(texts[first : k + 1]))
                first, held = k + 1, 0
        if not parts:
            return np.zeros((0, len(self.langs))), np.zeros(0, np.int64)
        return np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts])

    def _texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        numbers: dict[str, int] = {}
        found = [[numbers.setdefault(w, len(numbers)) for w in words_of(x)] for x in texts]
        listed = list(numbers)
        use = np.fromiter(map(has_letter, listed), bool, len(listed))
        nats, chars = np.zeros((len(listed), len(self.langs))), np.zeros(len(listed), np.int64)
        spelled = np.flatnonzero(use)
        for k in range(0, len(spelled) if self.langs else 0, ASKED_WORDS):
            part = spelled[k : k + ASKED_WORDS]
            nats[part], chars[part] = self.word_bits([listed[x] for x in part.tolist()])
        counts = np.array([len(x) for x in found], np.int64)
        flat = np.fromiter((x for own in found for x in own), np.int64, int(counts.sum()))
        docs = np.repeat(np.arange(len(texts)), counts)
        n = np.bincount(docs, chars[flat], minlength=len(texts)).astype(np.int64)
        sums = [np.bincount(docs, nats[flat, k], minlength=len(texts)) for k in range(len(self.langs))]
        table = np.stack(sums, 1) if sums else np.zeros((len(texts), 0))
        return table / np.maximum(n, 1)[:, None], n


def _around(points: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the ``length`` characters that end at each of ``ends``."""
    out = np.zeros(len(ends), np.uint64)
    with np.errstate(over="ignore"):
        for back in range(length - 1, -1, -1):
            out = (out ^ (points[ends - back].astype(np.uint64) + np.uint64(1))) * _MULTIPLY
            out = out ^ (out >> np.uint64(29))
    return out


def measured(label: np.ndarray, table: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """What calibration takes of labelled rows: where each is counted, its characters, and its loss at each temperature."""
    truth = np.arange(len(n)), label
    losses = [-np.log(posterior(table, n, t)[truth] + 1e-12) for t in TEMPERATURES]
    length, step = np.floor(LENGTHS * np.log2(n)), np.rint(STEPS * table.min(1))
    out = {"own": table.argmin(1), "length": length.astype(np.int64), "step": step.astype(np.int64), "n": n}
    return out | {f"loss{k}": x for k, x in enumerate(losses)}


class Calibration:
    """The temperature of the posterior, and what cross-entropy is usual for a language and a length."""

    def __init__(self, langs: list[str], rows=()):
        """``rows``: (lang, cross-entropies, characters) of labelled rows that the models have not seen."""
        self.temperature, self.usual, self.limit, self.rows = 0.1, {}, None, 0
        rows = [(langs.index(x), np.array(c), n) for x, c, n in rows if n and x in langs]
        if rows:
            found = measured(np.array([x for x, _, _ in rows]), np.stack([c for _, c, _ in rows]), np.array([n for _, _, n in rows]))
            ones = np.ones(len(rows), np.int64)
            self._count([found[f"loss{k}"].sum() for k in range(len(TEMPERATURES))], *[found[x] for x in ("own", "length", "step")], ones, found["n"])

    @classmethod
    def counted(cls, langs: list[str], rows: DataFrame) -> Calibration:
        """From a table of what ``measured`` gives for each row."""
        self, names = cls(langs), [f"loss{k}" for k in range(len(TEMPERATURES))]
        counts = [F.count(F.lit(1)).alias("rows"), F.min("n").alias("shortest")]
        cells = stored(rows.groupBy("own", "length", "step").agg(*counts, *[F.sum(x).alias(x) for x in names]), "language-calibration")
        found = cells.select("own", "length", "step", "rows", "shortest").toArrow()
        if found.num_rows:
            self._count(list(cells.agg(*map(F.sum, names)).first()), *[x.to_numpy() for x in found.columns])
        return self

    def _count(self, losses, own, length, step, rows, shortest) -> None:
        """Settle everything by cells of ``rows`` rows each."""
        self.temperature, self.rows = TEMPERATURES[int(np.argmin(losses))], int(rows.sum())
        best, centre = step / STEPS, np.full(int(own.max()) + 1, np.inf)
        for k in np.unique(own).tolist():
            centre[k] = _median(best[own == k], rows[own == k])
        # what a language with few rows is measured by: the deviations of all languages
        pooled = max(LEAST_SPREAD, _spread(best - centre[own], rows))
        for k in np.unique(own).tolist():
            at = np.flatnonzero(own == k)
            self.usual[k] = []
            for x in _bands(at, length[at], rows[at]):
                spread = _spread(best[x], rows[x])
                least = LEAST_SPREAD if rows[x].sum() >= BAND_ROWS else pooled
                self.usual[k].append((int(shortest[x].min()), _median(best[x], rows[x]), max(least, spread)))
        self.limit = FURTHEST

    def accepts(self, best: np.ndarray, own: np.ndarray, n: np.ndarray) -> np.ndarray:
        if self.limit is None:
            return n > 0
        most = np.full(len(best), np.inf)
        for k, bands in self.usual.items():
            at = np.flatnonzero(own == k)
            shortest, median, spread = (np.array(x) for x in zip(*bands, strict=True))
            band = np.maximum(np.searchsorted(shortest, n[at], side="right") - 1, 0)
            # texts shorter than all of the band's vary more, by the root of the characters they lack
            shorter = np.sqrt(np.maximum(shortest[band] / np.maximum(n[at], 1), 1.0))
            most[at] = median[band] + self.limit * spread[band] * shorter
        return (n > 0) & (best <= most)


def _bands(cells: np.ndarray, length: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """The cells in bands of neighbouring lengths with about as many rows each, at most one an octave, none with few."""
    lengths, place = np.unique(length, return_inverse=True)
    many = np.bincount(place, rows)
    parts = max(1, min(int(many.sum()) // BAND_ROWS, int((lengths[-1] - lengths[0]) / LENGTHS) + 1))
    band, number, held = np.zeros(len(lengths), np.int64), 0, 0
    for k, n in enumerate(many.tolist()):
        band[k], held = number, held + n
        if held * parts >= many.sum():
            number, held = number + 1, 0
    if held and number:  # what is left over belongs to the last band
        band[band == number] = number - 1
    return [cells[band[place] == b] for b in np.unique(band).tolist()]


def _median(values: np.ndarray, rows: np.ndarray) -> float:
    """The median where each value stands for so many rows."""
    order = np.argsort(values, kind="stable")
    upto, half = np.cumsum(rows[order]), rows.sum() / 2
    low, high = np.searchsorted(upto, half, side="left"), np.searchsorted(upto, half, side="right")
    return float(values[order[[low, high]]].mean())


def _spread(values: np.ndarray, rows: np.ndarray) -> float:
    """The standard deviation, by the median absolute deviation."""
    return 1.4826 * _median(np.abs(values - _median(values, rows)), rows)


def posterior(table: np.ndarray, n: np.ndarray, temperature: float) -> np.ndarray:
    bits = -table * n[:, None] * temperature
    out = np.exp(bits - bits.max(1, keepdims=True))
    return out / out.sum(1, keepdims=True)


def fitted(counts: DataFrame, order: int = ORDER, part_rows: int = PART_ROWS) -> tuple[Models, Models]:
    """The models of all of ``counts`` (lang, seen, sequence, n) and of what is ``seen``."""
    langs = sorted(x["lang"] for x in counts.select("lang").distinct().collect())
    if not langs:
        return Models([], [], order), Models([], [], order)
    spark, rows = counts.sparkSession, stored(hashed(smoothed(counts, langs)), "language-shares")
    return tuple(Models(langs, _files(spark, rows.where(own), part_rows), order) for own in (~F.col("early"), F.col("early")))


def fit(docs: DataFrame, held_out, order: int = ORDER, part_rows: int = PART_ROWS):
    """(models, calibration) learned from the rows of ``docs`` for which the column ``held_out`` is false."""
    spark = docs.sparkSession
    learned = docs.where(~held_out & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select(
        "doc_id", "text", "lang", (fold() != 3).alias("seen")
    )
    models, early = fitted(stored(sequence_counts(learned, order), "language-counts"), order, part_rows)
    if not models.langs:
        return models, Calibration([])
    sent = spark.sparkContext.broadcast(early)

    def run(batches):
        models = sent.value
        place = {x: k for k, x in enumerate(models.langs)}
        for batch in batches:
            table, n = models.texts(batch.column("text").to_pylist())
            label = np.array([place.get(x, -1) for x in batch.column("lang").to_pylist()], np.int64)
            use = (n > 0) & (label >= 0)
            found = measured(label[use], table[use], n[use])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found.values()], list(found))
        _let_go()

    schema = "own long, length long, step long, n long, " + ", ".join(f"loss{k} double" for k in range(len(TEMPERATURES)))
    rows = learned.where(~F.col("seen")).select("text", "lang").mapInArrow(run, schema)
    return models, Calibration.counted(models.langs, rows)


def predict(docs: DataFrame, models: Models, calibration: Calibration, carry: bool = False) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy, accepted of every row and, with ``carry``, the row itself as a struct."""
    sent = docs.sparkSession.sparkContext.broadcast((models, calibration))
    schema = "doc_id long, lang_pred string, score double, cross_entropy double, accepted boolean"

    def run(batches):
        models, calibration = sent.value
        for batch in batches:
            table, n = models.texts(batch.column("text").to_pylist())
            if not models.langs:
                n = np.zeros_like(n)
                table = np.zeros((len(n), 1))
            own, best = table.argmin(1), table.min(1)
            score = np.where(n > 0, posterior(table, n, calibration.temperature).max(1), 0.0)
            names = [models.langs[k] if m else "und" for k, m in zip(own.tolist(), n.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(names, pa.string()), pa.array(score), pa.array(best), pa.array(calibration.accepts(best, own, n))]
                + [batch.column(x) for x in [ROW] * carry],
                ["doc_id", "lang_pred", "score", "cross_entropy", "accepted"] + [ROW] * carry,
            )
        _let_go()

    return carried(docs, ["doc_id", "text"], carry).mapInArrow(run, schema_of(schema, docs, carry))
