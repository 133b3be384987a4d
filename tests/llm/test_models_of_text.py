"""Quality, rules, language and toxicity: against brute force, and on held-out documents."""

import itertools
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from conftest_llm import hostile_rows, prose
from pyspark.sql import functions as F

from windrow.llm import line_quality, piece_language, robust_rules, toxicity
from windrow.llm.queries import QUERIES

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def area(scores, labels):
    """Share of pairs of a 1 and a 0 that the scores put right."""
    ones, zeros = [s for s, y in zip(scores, labels) if y], [s for s, y in zip(scores, labels) if not y]
    order = np.sort(zeros)
    below = np.searchsorted(order, ones, "left") + np.searchsorted(order, ones, "right")
    return below.mean() / 2 / len(zeros)


# -- quality --------------------------------------------------------------------


def test_marginals_against_all_label_sequences():
    random = np.random.default_rng(1)
    sizes = np.array([1, 4, 2, 5])
    potential, table = random.normal(0, 2, 12), np.exp(random.normal(0, 1, (2, 2)))
    got = line_quality.Chains(sizes).marginals(potential, table)
    at = 0
    for size in sizes:
        weight = np.zeros(size)
        total = 0.0
        for labels in itertools.product((0, 1), repeat=int(size)):
            w = math.exp(sum(potential[at + i] for i in range(size) if labels[i]))
            w *= math.prod(table[a, b] for a, b in zip(labels, labels[1:]))
            total += w
            weight += w * np.array(labels)
        assert got[at : at + size] == pytest.approx(weight / total, rel=1e-9)
        at += size


def test_no_chains():
    assert len(line_quality.Chains(np.zeros(0, np.int64)).marginals(np.zeros(0), np.ones((2, 2)))) == 0


def labelled(spark, sf_dir, name):
    return {r.doc_id: r[name] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}


def test_quality_of_held_out_documents(spark, medium):
    got, labels = QUERIES["op1_crf_quality"](spark, medium).collect(), labelled(spark, medium, "quality")
    assert len(got) == spark.read.parquet(f"{medium}/documents.parquet").count()
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert area(*zip(*held)) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_quality_in_degenerate_cases(spark, hostile, nothing):
    labels = spark.createDataFrame([(5, 1), (7, 0), (8, None), (99, 1)], "doc_id long, quality int")
    field = line_quality.train(hostile, labels)
    scored = line_quality.score_texts(hostile, field, ["doc_id"]).collect()
    assert len(scored) == len(hostile_rows()) and all(0 <= r.score <= 1 for r in scored)
    lines = Counter(len((r[1] or "").split("\n")) for r in hostile_rows())
    assert Counter(len(r.line_scores) for r in scored) == lines
    assert line_quality.train(hostile, labels.where("quality = 1")) == 1.0
    assert line_quality.train(nothing, labels) == 1.0
    assert {r.score for r in line_quality.score_texts(hostile, 0.0, ["doc_id"]).collect()} == {0.0}
    assert line_quality.score_texts(nothing, field, ["doc_id"]).count() == 0


# -- rules ----------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    said = WORD.findall(text or "")
    windows = Counter(tuple(said[i : i + 5]) for i in range(len(said) - 4))
    covered = {j for i in range(len(said) - 4) if windows[tuple(said[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        again += bool(WORD.search(line)) and line in seen
        seen.add(line)
    return len(said), sum(map(len, said)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered)


def test_counts_of_all_documents(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = QUERIES["op3_mcd_quality_rules"](spark, small).collect()
    assert len(got) == len(docs)
    for r in got:
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts == brute_counts(docs[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_counts_of_hostile_rows(hostile):
    got = robust_rules.quality_rules(hostile).collect()
    have = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert have == sorted((r[0] or -1, *brute_counts(r[1])) for r in hostile_rows())
    assert all(r.kept == (not r.base_failed) for r in got)  # groups this small have no estimate


def test_windows_of_many_distinct_words():
    said = [str(i % 9000).encode() for i in range(20_000)]
    assert robust_rules.repeated_words(said) == 20_000


def test_quantiles():
    assert robust_rules.chi2_quantile(0.95) == pytest.approx(9.487729, abs=1e-5)
    assert robust_rules._chi2(12.591587, 6) == pytest.approx(0.95, abs=1e-7)


def plain_mcd(points, starts=60):
    """Concentration steps on the points themselves, without cells."""
    n, total = len(points), math.ceil(robust_rules.SHARE * len(points))
    random, best = np.random.default_rng(5), None
    ridge = np.eye(points.shape[1]) * robust_rules.FLOOR**2
    for start in range(starts):
        chosen = points[random.choice(n, 5, replace=False)] if start else points
        last = math.inf
        while True:
            mean, scatter = chosen.mean(0), np.cov(chosen.T, bias=True) + ridge
            size = np.linalg.slogdet(scatter)[1]
            if size >= last - 1e-9:
                break
            last = size
            distance = np.einsum("ij,jk,ik->i", points - mean, np.linalg.inv(scatter), points - mean)
            chosen = points[np.argsort(distance, kind="stable")[:total]]
        if best is None or last < best[0]:
            best = (last, mean, scatter)
    return best


def test_estimates_against_steps_on_the_points(spark):
    random = np.random.default_rng(3)
    shape = np.array([[1, 0.6, 0, 0], [0, 1, 0.3, 0], [0, 0, 0.7, 0], [0, 0, 0, 0.5]])
    points = np.concatenate([random.normal(size=(700, 4)) @ shape, random.normal(size=(120, 4)) * 0.3 + 6])
    cells = defaultdict(list)
    for p in points:
        cells[tuple(np.floor(p / robust_rules.CELL))].append(p)
    groups = [np.array(c) for c in cells.values()]
    weight = np.array([len(g) for g in groups], float)
    sums, products = np.array([g.sum(0) for g in groups]), np.array([g.T @ g for g in groups])
    mean, scatter = robust_rules.minimum_determinant(weight, sums, products)
    size, plain_mean, _ = plain_mcd(points)
    assert mean == pytest.approx(plain_mean, abs=0.12)  # reweighted against raw
    distance = robust_rules._distances(points, mean, scatter)
    cut = robust_rules.chi2_quantile(0.999)
    assert (distance[700:] > cut).all() and (distance[:700] <= cut).mean() > 0.98


def test_outliers_of_a_group_are_rejected(spark):
    clean = [(i, prose(i, 80 + i % 40), "en", "a") for i in range(200)]
    odd = [(1000 + i, " ".join(w + "###" for w in prose(300 + i, 80).split()), "en", "a") for i in range(30)]
    docs = spark.createDataFrame(clean + odd, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in robust_rules.quality_rules(docs).collect()}
    assert not any(got[1000 + i].kept for i in range(30))
    passed = [got[i].kept for i in range(200) if not got[i].base_failed]
    assert sum(passed) >= 0.98 * len(passed)


def test_small_groups_take_the_estimate_of_their_language_or_of_all(spark):
    """A source per document, as web data has it: outliers go all the same."""
    clean = [(i, prose(i, 80 + i % 40), "en", f"host{i}") for i in range(150)]
    rare = [(500 + i, prose(700 + i, 90), "xx", None) for i in range(5)]
    odd = [(1000 + i, " ".join(w + "###" for w in prose(300 + i, 80).split()), ("en", "xx", None)[i % 3], f"odd{i}") for i in range(9)]
    docs = spark.createDataFrame(clean + rare + odd, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in robust_rules.quality_rules(docs).collect()}
    assert len(got) == len(clean) + len(rare) + len(odd)
    assert not any(got[1000 + i].kept for i in range(9))
    passed = [r.kept for r in got.values() if r.doc_id < 1000 and not r.base_failed]
    assert len(passed) > 100 and sum(passed) >= 0.97 * len(passed)
    few = robust_rules.quality_rules(docs.where("doc_id < 10")).collect()
    assert all(r.kept != r.base_failed and r.distance is None for r in few)


def test_clean_documents_are_kept(spark, medium):
    labels = labelled(spark, medium, "quality")
    got = [r for r in QUERIES["op3_mcd_quality_rules"](spark, medium).collect() if not r.base_failed and r.doc_id in labels]
    good = [r.kept for r in got if labels[r.doc_id]]
    assert sum(good) >= 0.97 * len(good)


def test_rules_of_nothing(nothing):
    assert robust_rules.quality_rules(nothing).count() == 0


# -- language -------------------------------------------------------------------


def test_forward_and_expected_counts_against_all_segmentations():
    lattice = piece_language.Lattice(sorted(["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab", "c"]))
    random = np.random.default_rng(0)
    chance = random.random((len(lattice.pieces) + 1, 2))
    number = {p: i for i, p in enumerate(lattice.pieces)}

    def ways(word):
        if not word:
            yield []
        for end in range(1, len(word) + 1):
            piece = number.get(word[:end], lattice.unknown if end == 1 else None)
            if piece is not None:
                yield from ([piece, *rest] for rest in ways(word[end:]))

    given = ["▁abab", "▁c", "▁bazaba", "▁zz"]
    logs = lattice.forward(given, chance)
    into = np.zeros(len(chance))
    lattice.expected(given, np.array([1.0, 2.0, 3.0, 1.0]), chance[:, 0].copy(), into)
    want = np.zeros(len(chance))
    for word, weight, row in zip(given, (1, 2, 3, 1), logs):
        all_ways = list(ways(word))
        for k in range(2):
            total = sum(math.prod(chance[p, k] for p in way) for way in all_ways)
            assert row[k] == pytest.approx(math.log(total))
        total = sum(math.prod(chance[p, 0] for p in way) for way in all_ways)
        for way in all_ways:
            for p in way:
                want[p] += weight * math.prod(chance[q, 0] for q in way) / total
    assert into == pytest.approx(want)


def test_long_runs_are_summed_whole(monkeypatch):
    """Letter by letter or together, in plain products or logs: the same sums and the same expected pieces."""
    assert piece_language.cut_words("ab" * 40 + " 東京" + "都" * 70) == ["▁" + "ab" * 40, "▁東京" + "都" * 70]
    lattice = piece_language.Lattice(sorted(["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab", "c", "bbbbbb"]))
    random = np.random.default_rng(2)
    chance = random.random((len(lattice.pieces) + 1, 3)) * [0.9, 1e-3, 1e-12]
    pick = np.random.default_rng(4)
    words = ["▁" + "".join(pick.choice(list("abcz"), p=[0.45, 0.45, 0.05, 0.05], size=n)) for n in (1, 31, 32, 33, 60, 64, 65, 130)]
    logs = lattice.forward(words, chance)
    assert logs == pytest.approx(lattice.forward_in_logs(words, chance), rel=1e-12)
    weight, even = np.arange(1.0, len(words) + 1), np.full(len(chance), 0.1)
    into = np.zeros(len(chance))
    lattice.expected(words, weight, even, into)
    monkeypatch.setattr(piece_language, "LONGEST", 1000)
    together = np.zeros(len(chance))
    lattice.expected(words, weight, even, together)
    assert into == pytest.approx(together, rel=1e-9)
    far = lattice.forward_long("▁" + "ab" * 20_000, chance)
    assert np.isfinite(far).all() and (far < -1000).any()


def test_sums_of_runs_of_untrained_letters_at_a_large_corpus():
    lattice = piece_language.Lattice(sorted(["▁", "▁th", "th", "t", "h", "e", "the", "▁the"]))
    chance = np.array([[0.2, 1e-6], [0.1, 1e-9], [0.05, 0.1], [0.3, 0.01], [0.02, 0.2], [1e-7, 0.1], [0.1, 0.2], [0.2, 0.1]])
    chance = np.concatenate([chance, [[3e-25, 1e-12]]])  # a letter outside the vocabulary
    number = {p: i for i, p in enumerate(lattice.pieces)}

    def exact(word, k):
        reach = [Fraction(1)] + [Fraction(0)] * len(word)
        for start in range(len(word)):
            for end in range(start + 1, len(word) + 1):
                piece = number.get(word[start:end], lattice.unknown if end == start + 1 else None)
                if piece is not None:
                    reach[end] += reach[start] * Fraction(chance[piece, k])
        return math.log(reach[-1].numerator) - math.log(reach[-1].denominator)

    words = ["▁the", "▁" + "ж" * 32, "▁" + "ж" * 12, "▁the" + "ж" * 25 + "thet", "▁thethe"]
    logs = lattice.forward(words, chance)
    for word, row in zip(words, logs):
        assert row == pytest.approx([exact(word, k) for k in range(2)], rel=1e-12)


def test_a_run_of_untrained_letters_does_not_decide(spark):
    docs = spark.createDataFrame([(1, prose(1, 300), "en"), (2, "zwölf boxkämpfer jagen viktor quer über den sylter deich " * 4, "de")], "doc_id long, text string, lang string")
    langs, chance = piece_language.learn(docs, PIECES)
    known = set("".join(piece_language.vocabulary(PIECES).pieces))
    letter = next(c for c in map(chr, range(0x1400, 0x1680)) if c.isalpha() and c not in known)
    chance = chance.copy()
    chance[-1, langs.index("en")], chance[-1, langs.index("de")] = 3e-15, 1e-12  # as at 0.5 GB of text, mostly English
    texts = [(n, prose(5, 400) + " " + letter * n) for n in (0, 8, 23, 28, 32)]
    probe = spark.createDataFrame(texts, "doc_id long, text string")
    got = piece_language.predict(probe, langs, chance, PIECES, ["doc_id"]).collect()
    assert {(r.doc_id, r.lang_pred) for r in got} == {(n, "en") for n, _ in texts}
    assert all(r.score > 0.99 for r in got)


def test_language_of_held_out_documents(spark, medium):
    got = QUERIES["op5_piece_language"](spark, medium).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    assert len(got) == len(lang)
    held = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert sum(held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_in_degenerate_cases(hostile, nothing):
    langs, chance = piece_language.learn(hostile, PIECES)
    assert langs == ["en", "xx"]
    got = piece_language.predict(hostile, langs, chance, PIECES, ["doc_id"]).collect()
    assert len(got) == len(hostile_rows())
    for r in got:
        texts = [t for d, t, *_ in hostile_rows() if d == r.doc_id]
        if r.lang_pred == "und":
            assert r.score == 0 and any(not any(c.isalpha() for c in t or "") for t in texts)
        else:
            assert any(any(c.isalpha() for c in t or "") for t in texts)
    langs, chance = piece_language.learn(nothing, PIECES)
    assert langs == []
    got = piece_language.predict(hostile, langs, chance, PIECES, ["doc_id"]).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert piece_language.predict(nothing, langs, chance, PIECES, ["doc_id"]).count() == 0


# -- toxicity -------------------------------------------------------------------


def brute_model(rows):
    """Log ratio after any context, straight from the definition of the two models."""
    counts = [Counter(), Counter()]
    for text, toxic in rows:
        padded = " " * 4 + "".join(c.lower() if c.isalpha() else " " for c in text) + " "
        counts[toxic].update(padded[i : i + 5] for i in range(len(padded) - 4))
    kinds = counts[0].keys() | counts[1].keys()
    shared = {}
    for size in range(4, 0, -1):
        shared[size] = Counter(g[1:] for g in kinds)
        kinds = set(shared[size])

    def backoff(context, letter):
        size = len(context) + 1
        table = shared[size]
        if size == 1:
            return table[letter] / sum(table.values())
        after = {g: n for g, n in table.items() if g[:-1] == context}
        own = max(after.get(context + letter, 0) - 0.75, 0) / sum(after.values())
        return own + 0.75 * len(after) / sum(after.values()) * backoff(context[1:], letter)

    def ratio(gram):
        logs = []
        for table in counts:
            after = {g: n for g, n in table.items() if g[:-1] == gram[:-1]}
            total = sum(after.values())
            left = 0.75 * len(after) / total if total else 1.0
            logs.append(math.log(max(after.get(gram, 0) - 0.75, 0) / max(total, 1) + left * backoff(gram[1:4], gram[4])))
        return logs[1] - logs[0]

    return counts, ratio


def test_ratios_against_the_definition(spark):
    rows = [(prose(i, 8), 0) for i in range(6)] + [("you silly " + prose(9, 5) + " silly", 1), ("a silly fox", 1)]
    frame = spark.createDataFrame(rows, "text string, toxic int").repartition(3)
    grams = toxicity.gram_counts(frame, "text", "toxic")
    seen = toxicity.likelihood_ratios(grams)
    counts, ratio = brute_model(rows)
    got = {r.gram: r for r in seen.collect()}
    assert set(got) == counts[0].keys() | counts[1].keys()
    for gram, r in got.items():
        assert r.weight == counts[0][gram] + counts[1][gram]
        assert r.ratio == pytest.approx(ratio(gram), rel=1e-9, abs=1e-9)
    table = toxicity.bucketed(seen)
    for gram, r in got.items():
        code = toxicity.gram_codes(np.frombuffer(gram.encode("utf-32-le"), "<u4"))
        assert table[toxicity.buckets(code)[0]] == pytest.approx(r.ratio, rel=1e-5, abs=1e-6)


def test_every_gram_has_a_ratio_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BITS", 5)  # far more grams than 2 ** BITS
    rows = [(prose(i, 40), 0) for i in range(6)] + [("you silly " + prose(9, 5) + " silly", 1), ("a silly fox", 1)]
    seen = toxicity.likelihood_ratios(toxicity.gram_counts(spark.createDataFrame(rows, "text string, toxic int"), "text", "toxic"))
    table, got = toxicity.bucketed(seen), {r.gram: r.ratio for r in seen.collect()}
    assert len(got) > 8 * 2**toxicity.BITS

    def keys(grams):
        return toxicity.buckets(toxicity.gram_codes(np.frombuffer("".join(grams).encode("utf-32-le"), "<u4"))[::5])

    assert table[keys(got)] == pytest.approx(list(got.values()), rel=1e-9, abs=1e-12)
    strange = [chr(0x4E00 + i) * 5 for i in range(500)]
    assert not table[keys(strange)].any()
    # Tasks that read the model block by block give what the definition gives.
    probe = [(1, "the silly fox"), (2, "quick brown 東京東京東京"), (3, prose(77, 60))]
    docs = spark.createDataFrame(probe, "doc_id long, text string")
    for r in toxicity.score_texts(docs, (table, 1.0, 0.0), ["doc_id"]).collect():
        padded = " " * 4 + "".join(c if c.isalpha() else " " for c in dict(probe)[r.doc_id]) + " "
        each = [got.get(padded[i : i + 5], 0.0) for i in range(len(padded) - 4)]
        n = min(toxicity.STRETCH, len(each))
        assert r.ratio == pytest.approx(max(sum(each[i : i + n]) / n for i in range(len(each) - n + 1)), rel=1e-9, abs=1e-9)


def test_the_worst_stretch_decides(spark):
    insult = "scum "
    rows = [(i, prose(i, 200), 0) for i in range(60)]
    rows += [(100 + i, prose(200 + i, 30) + " " + insult + prose(300 + i, 30), 1) for i in range(20)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    probe = spark.createDataFrame([(1, prose(900, 400) + " scum " + prose(901, 400)), (2, prose(902, 800)), (3, ""), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score_texts(probe, model, ["doc_id"]).collect()}
    assert got[1] > 0.5 > got[2] and got[3] < 0.5 and got[4] == got[3]


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    got, labels = QUERIES["op7_kneser_ney_toxicity"](spark, folder).collect(), labelled(spark, folder, "toxic")
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert area(*zip(*held)) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_toxicity_in_degenerate_cases(spark, hostile, nothing):
    labels = spark.createDataFrame([(5, 1), (7, 0), (8, None), (99, 1)], "doc_id long, toxic int")
    model = toxicity.train(hostile, labels)
    got = toxicity.score_texts(hostile, model, ["doc_id"]).collect()
    assert len(got) == len(hostile_rows()) and all(0 <= r.score <= 1 for r in got)
    for few in (labels.where("toxic = 0"), labels.where("toxic = 5")):
        assert toxicity.train(hostile, few) is None
    assert {r.score for r in toxicity.score_texts(hostile, None, ["doc_id"]).collect()} == {0.0}
    assert toxicity.score_texts(nothing, model, ["doc_id"]).count() == 0


def test_scores_do_not_depend_on_layout(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    held = F.col("doc_id") % 2 == 0
    langs, chance = piece_language.learn(docs.where(~held), PIECES)
    again = piece_language.learn(docs.where(~held).repartition(7), PIECES)
    assert langs == again[0] and chance == pytest.approx(again[1], rel=1e-9)
