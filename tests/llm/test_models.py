import math
import random
import re
import time
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.rows import LONG, ODD_TEXTS, frame
from tradewatch.llm import queries
from tradewatch.llm.kneserney import END, START, Calibration, _sequences, fit, fitted, fold, measured, predict, sequence_counts
from tradewatch.llm.semicrf import EMAIL_TOKENS, KINDS, PATTERNS, TRAIN_REGIONS, added_up, all_spans, base_spans, best_segments, candidates, counted_lessons, find_personal_data, groups, holds, lessons, luhn, masked, train, written
from tradewatch.llm.semicrf import fit as fit_field

ORDER = 3


def brute_chance(counts, order, sequence):
    """Interpolated Kneser-Ney probability of the last character, from counts of the longest sequences."""
    levels = [Counter() for _ in range(order + 1)]
    for s, n in counts.items():
        levels[len(s)][s] += n
    for length in range(order, 1, -1):
        for s in list(levels[length]):
            levels[length - 1][s[1:]] += 1

    def chance(s):
        if not s:
            return 1 / (1 << 12)
        level = levels[len(s)]
        once, twice = (sum(n == k for n in level.values()) for k in (1, 2))
        d = once / (once + 2 * twice) if once else 0.5
        total = sum(n for x, n in level.items() if x[:-1] == s[:-1])
        kinds = sum(x[:-1] == s[:-1] for x in level)
        if not total:
            return chance(s[1:])
        return max(level[s] - d, 0) / total * (level[s] > 0) + d * kinds / total * chance(s[1:])

    return chance(sequence)


def models_of(spark, words, part_rows=1_000_000):
    sequences, n = _sequences(words, ORDER)
    rows = [("x", False, s, int(k)) for s, k in zip(sequences, n, strict=True)]
    return fitted(spark.createDataFrame(rows, "lang string, seen boolean, sequence string, n long"), ORDER, part_rows)[0]


def test_smoothing_against_brute_force(spark):
    words = Counter({"abab": 3, "ba": 2, "aé": 1, "b": 5})
    sequences, n = _sequences(words, ORDER)
    counts = dict(zip(sequences, n.tolist(), strict=True))
    want = Counter()
    for w, m in words.items():
        s = START + w + END
        for k in range(1, len(s)):
            want[s[max(0, k - ORDER + 1) : k + 1]] += m
    assert counts == want
    models = models_of(spark, words)
    for word in ["abab", "ba", "zzz", "a", "bé", "abé"]:
        s = START + word + END
        nats = -sum(math.log(brute_chance(counts, ORDER, s[max(0, k - ORDER + 1) : k + 1])) for k in range(1, len(s)))
        got, chars = models.word_bits([word])
        assert chars[0] == len(word) + 1 and abs(got[0, 0] - nats) < 1e-4 * nats


def test_files_of_any_size_predict_the_same(spark):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents")
    whole, small = (fit(docs, F.coalesce(fold() == 2, F.lit(False)), part_rows=n) for n in (10**9, 5000))
    assert len(whole[0].files) == 1 and len(small[0].files) > 5 and whole[0].langs == small[0].langs
    got, want = (sorted(map(str, predict(docs, *x).collect())) for x in (small, whole))
    assert got == want


def test_probabilities_sum_to_at_most_one(spark):
    models = models_of(spark, Counter({"abc": 2, "acb": 1, "bb": 1}))
    ends = [math.exp(-models.word_bits(["a" + c])[0][0, 0] + models.word_bits(["a" + c + "q"])[0][0, 0] * 0) for c in "abc"]
    assert all(0 < x < 1 for x in ends)


def test_counts_cover_all_rows(spark):
    docs = spark.createDataFrame([("ab ab 12", "x", True), ("ab", "x", False), (None, "y", True), ("", "y", True)], "text string, lang string, seen boolean")
    got = {(x["lang"], x["seen"], x["sequence"]): x["n"] for x in sequence_counts(docs, 3).collect()}
    assert got[("x", True, START + "ab")] == 2 and got[("x", False, "ab" + END)] == 1
    assert not any("1" in s for _, _, s in got)


def test_held_out_accuracy_and_rejection(spark):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents")
    rows = queries.op10_languages(spark, "/root/testdata/sf0.001").join(docs, "doc_id").where("held_out and lang_pred <> 'und'")
    got = [(x["lang"] == x["lang_pred"], x["accepted"]) for x in rows.collect()]
    assert np.mean([x for x, _ in got]) > 0.95 and np.mean([x for _, x in got]) > 0.98
    junk = spark.createDataFrame([(1, "zqxj wvkq jjxz qqzw xkcd zzvq " * 20), (2, "1234 ;;; 99"), (3, None), (4, "")], "doc_id long, text string")
    models, calibration = fit(docs, F.coalesce(fold() == 2, F.lit(False)))
    said = {x["doc_id"]: x for x in predict(junk, models, calibration).collect()}
    assert not said[1]["accepted"] and 0 <= said[1]["score"] <= 1
    assert all(said[k]["lang_pred"] == "und" and said[k]["score"] == 0 and not said[k]["accepted"] for k in (2, 3, 4))


def test_odd_rows_and_carried_columns(spark):
    docs = frame(spark, list(enumerate(ODD_TEXTS)) + [(None, "the fox")], {k: "en" for k in range(5)})
    models, calibration = fit(docs, F.lit(False))
    rows = predict(docs, models, calibration, carry=True)
    assert rows.select("_doc.*").columns == docs.columns and rows.count() == len(ODD_TEXTS) + 1
    nothing = fit(docs.where("false"), F.lit(False))
    assert {x["lang_pred"] for x in predict(docs, *nothing).collect()} == {"und"}
    assert predict(docs.where("false"), models, calibration).count() == 0


def brute_base(text):
    out = []
    for kind in KINDS:
        out += [(kind, *m.span()) for m in PATTERNS[kind].finditer(text) if holds(kind, m[0])]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


PII = st.lists(st.sampled_from(["a.b", "@", "x.org", ".", "1", "23", "255", "4465758382889437", " ", "-", "+1", "(449) 555-9658", "é", "+", "%"]), max_size=14)


@settings(max_examples=500, deadline=None)
@given(PII)
def test_base_spans_against_patterns(parts):
    text = "".join(parts)
    base, spans = all_spans(text, {k: np.array([5.0] + [0.0] * 8) for k in KINDS})
    assert base == brute_base(text)
    assert set(base) <= set(spans)
    for kind, a, b in set(spans) - set(base):
        assert PATTERNS[kind].fullmatch(text[a:b]) and holds(kind, text[a:b])


def test_luhn_and_long_runs():
    assert luhn("4465758382889437") and not luhn("4465758382889438")
    assert base_spans("1" * 100_000)[0] == [] and base_spans("a" * 200_000 + "@")[0] == []
    assert not holds("ip", "1.2.3." + "9" * 5000) and holds("ip", "1.2.3.000255")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["1.2.3.4", " ", "5", ".", "66", "a@b.c"]), min_size=1, max_size=6), st.integers(0, 9))
def test_decoding_against_all_segmentations(parts, seed):
    text = "".join(parts)
    n, found = candidates(text, 0, len(text))
    rng = np.random.default_rng(seed)
    weights = {k: rng.normal(size=9) for k in KINDS}

    def best(at):
        if at == n:
            return 0.0
        return max([best(at + 1)] + [float(weights[x[2]] @ x[5]) + best(x[1]) for x in found if x[0] == at])

    got = best_segments(n, found, weights)
    assert all(x[1] <= y[0] for x, y in zip(got, got[1:], strict=False))
    assert abs(sum(float(weights[x[2]] @ x[5]) for x in got) - best(0)) < 1e-9


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4", "44", "4465758382889437", "1.2.3.4", " ", "-", "  ", "+", "(", ".", "a@b.c", "x"]), max_size=45))
def test_candidates_against_all_runs_of_tokens(parts):
    text = "".join(parts)
    places = [m.span() for m in re.finditer("[A-Za-z]+|[0-9]+|[^A-Za-z0-9]", text)]
    runs = [(k, i, j) for k in KINDS for i in range(len(places)) for j in range(i, len(places)) if k != "email" or j - i < EMAIL_TOKENS]
    want = {(k, places[i][0], places[j][1]) for k, i, j in runs if PATTERNS[k].fullmatch(text[places[i][0] : places[j][1]])}
    assert {x[2:5] for x in candidates(text, 0, len(text))[1]} == {x for x in want if holds(x[0], text[x[1] : x[2]])}


def test_a_card_digit_by_digit_beside_a_number():
    card = " ".join("4111111111111111")
    text = f"9 {card} 9 1 2"
    assert base_spans(text)[0] == []
    found = candidates(text, 0, len(text))[1]
    assert ("card", 2, 2 + len(card)) in {x[2:5] for x in found}
    weights = train([f"they pay {' '.join(x)} more" for x in ("4465758382889437", "4111111111111111") for _ in range(20)])
    assert any(k == "card" and a >= 2 for k, a, _ in all_spans(f"9 {card} end", weights)[1])
    start = time.time()
    candidates(" ".join("4" * 20_000), 0, 39_999)
    assert time.time() - start < 20


def test_lessons_are_bounded_and_whole():
    texts = ["pay 4465758382889437 now " * 200, "x" * 40 + " 10.2.3.44 end", "4465758382889437 " * 2]
    got = [lessons(x) for x in texts]
    assert len(got[0]) == TRAIN_REGIONS and got[2] == []
    for excerpt, begin, stop, spans in got[0] + got[1]:
        assert len(excerpt) < 100 and spans and all(PATTERNS[k].fullmatch(excerpt[a:b]) and begin <= a < b <= stop for k, a, b in spans)


def test_the_sample_has_every_kind(spark):
    many = [(k, f"mail a{k}@b.org") for k in range(400)] + [(1000 + k, "pay 4465758382889437 now") for k in range(3)]
    weights = fit_field(frame(spark, many), train_docs=80)
    assert weights["card"].any() and weights["email"].any() and not weights["ip"].any()


def test_field_finds_what_greedy_matches_lose():
    random.seed(1)
    texts = [f"words {random.choice(['call', 'pay', 'at'])} {x} more words" for x in ("4465758382889437", "10.2.3.44", "+1 (449) 555-9658", "a.b@c.org") * 20]
    weights = train(texts)
    text = "cards 4465758382889437 4465758382889437 end"
    base, spans = all_spans(text, weights)
    assert base == [] and [text[a:b] for _, a, b in spans] == ["4465758382889437"] * 2
    assert masked(text, spans) == "cards <CARD> <CARD> end"
    assert all_spans("plain words 12 and 1234567890123 without any", weights) == ([], [])
    assert train([]) is None and written([("ip", 1, 2), ("card", 3, 4)]) == "ip:1:2,card:3:4"


def test_personal_data_on_odd_rows(spark):
    docs = frame(spark, list(enumerate(ODD_TEXTS)) + [(50, "write to a.b@c.org"), (None, "x 10.2.3.44"), (50, "write to a.b@c.org")])
    found = find_personal_data(docs, fit_field(docs), with_text=True, carry=True)
    rows = found.collect()
    assert len(rows) == len(ODD_TEXTS) + 3 and found.select("_doc.*").columns == docs.columns
    assert [x["spans"] for x in rows if x["doc_id"] == 50] == ["email:9:18"] * 2
    assert next(x for x in rows if x["doc_id"] is None)["n_ip"] == 1
    assert next(x for x in rows if x["doc_id"] == 2)["masked"] is None and re.fullmatch("[0-9a-f]{64}", rows[0]["base_sha256"])
    assert next(x for x in rows if x["doc_id"] == 4)["masked"] == LONG
    assert find_personal_data(frame(spark, []), None).count() == 0


def test_junk_and_long_rows_in_the_calibration_do_not_lift_the_limit():
    rng = np.random.default_rng(1)
    rows = []
    for k, lang in enumerate(("en", "fr")):
        for _ in range(400):
            n = int(rng.integers(50, 5000))
            table = [4.0, 4.0]
            table[k] = 2.0 + rng.normal(0, 0.05 + 0.5 / n**0.5)
            rows.append((lang, table, n))
    rows += [("fr", [7.5, 7.0], 300)] * 20 + [("en", [2.4, 4.0], 50_000_000)]
    calibration = Calibration(["en", "fr"], rows)
    clean = [r for r in rows if min(r[1]) < 2.3]
    got = calibration.accepts(np.array([min(r[1]) for r in clean]), np.array([int(np.argmin(r[1])) for r in clean]), np.array([r[2] for r in clean]))
    assert got.mean() > 0.99
    junk = calibration.accepts(np.full(4, 6.0), np.array([0, 1, 0, 1]), np.array([100, 100, 2000, 2000]))
    assert not junk.any()


def test_calibration_counts_all_rows(spark):
    texts = F.concat(F.lit("the old fox "), F.repeat(F.lit("runs home "), F.pmod(F.xxhash64("id"), F.lit(9)).cast("int")))
    mixed = F.when(F.col("id") % 2 == 0, texts).otherwise(F.concat(F.lit("der alte Fuchs "), texts))
    docs = spark.range(90_000).select(F.col("id").alias("doc_id"), mixed.alias("text"), F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"))
    _, calibration = fit(docs, F.coalesce(fold() == 2, F.lit(False)))
    unseen = docs.where(fold() == 3).count()
    assert unseen > 20_000 and calibration.rows == unseen


def test_counted_calibration_against_the_rows(spark):
    rng = np.random.default_rng(3)
    n = rng.integers(20, 4000, 700)
    table = np.stack([2 + rng.normal(0, 0.1, 700), 2.4 + rng.normal(0, 0.3, 700)], 1)
    label = table.argmin(1)
    got = measured(label, table, n)
    rows = spark.createDataFrame(list(zip(*[x.tolist() for x in got.values()], strict=True)), list(got))
    counted = Calibration.counted(["en", "fr"], rows)
    listed = Calibration(["en", "fr"], [(("en", "fr")[k], t, m) for k, t, m in zip(label.tolist(), table, n.tolist(), strict=True)])
    assert (counted.temperature, counted.usual, counted.rows) == (listed.temperature, listed.usual, 700)
    for k, bands in counted.usual.items():
        own = (table.argmin(1) == k) & (n >= bands[-1][0])
        assert abs(bands[-1][1] - np.median(table.min(1)[own])) < 1 / 256 and own.sum() >= 30
    assert Calibration.counted(["en"], rows.where("false")).limit is None


def brute_lesson(text, spans, weights):
    """Log-likelihood of the base spans in a region that is the whole text, over all segmentations."""
    n, found = candidates(text, 0, len(text))

    def scores(at):
        if at == n:
            return [0.0]
        own = [(float(weights[x[2]] @ x[5]), x[1]) for x in found if x[0] == at]
        return scores(at + 1) + [s + rest for s, j in own for rest in scores(j)]

    gold = sum(float(weights[x[2]] @ x[5]) for x in found if x[2:5] in set(spans))
    return gold - np.logaddexp.reduce(scores(0))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["1.2.3.4", " ", "5", ".", "66", "a@b.c", "x"]), min_size=1, max_size=6), st.integers(0, 9))
def test_groups_of_candidates_against_all_segmentations(parts, seed):
    text = "".join(parts)
    spans = [x for x in base_spans(text)[0]]
    flat = np.random.default_rng(seed).normal(size=36)
    counted = Counter(groups(text, 0, len(text), spans)).items()
    got = added_up(counted, flat)
    assert abs(got[1] - brute_lesson(text, spans, dict(zip(KINDS, flat.reshape(4, 9), strict=True)))) < 1e-9
    for k in np.flatnonzero(got[2:38]).tolist():  # gradient and covariance against small steps
        small = np.zeros(36)
        small[k] = 1e-5
        more, less = added_up(counted, flat + small), added_up(counted, flat - small)
        assert abs((more[1] - less[1]) / 2e-5 - got[2 + k]) < 1e-5
        assert np.abs((more[2:38] - less[2:38]) / 2e-5 + got[38:].reshape(36, 36)[k]).max() < 1e-5


def test_the_field_learns_from_all_documents(spark):
    def text(k):
        words = ["see", "visa", "call", "mail", "host"][k % 5]
        return f"{words} {['4465758382889437', '10.2.3.44', '+1 (449) 555-9658', 'a.b@c.org'][k * 7 % 11 % 4]} and " * (1 + 19 * (k % 500 == 0))

    texts = [text(k) for k in range(4000)] + ["pay " + "10.2.3.44 " * 150 + "end"]
    told = sum(counted_lessons(texts).values())
    weights = fit_field(frame(spark, list(enumerate(texts))))
    want = train(texts)
    assert told == 4000 + 8 * 19 + 150 and all(np.allclose(weights[k], want[k], atol=1e-6) for k in KINDS)
    assert not np.allclose(weights["card"], train(texts[::2])["card"], atol=1e-6)
    assert fit_field(frame(spark, [(1, "no such data"), (2, None)])) is None
