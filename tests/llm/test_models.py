"""Classifier, language model, fingerprints, segmentations, joins: against plain versions on small fixtures."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from loam.llm import components, fingerprints, ngram_join, quality_classifier, sentence_pieces, suffix_tree_lm

DOCS = "doc_id long, text string"


def texts(n, seed=0, words=120):
    draw = random.Random(seed)
    return [" ".join(draw.choice(["the", "of", "and", "a", f"w{draw.randrange(400)}"]) for _ in range(draw.randrange(3, words))) for _ in range(n)]


# Classifier


def test_flat_trees_score_as_walked_trees():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < -0.5)).astype(float)
    model = quality_classifier.fit(x, y, trees=20, depth=3, bins=16)

    def walked(row):
        total = model.base
        for f, t, v in zip(model.feature, model.limit, model.value, strict=True):
            at = 0
            while at < len(f):
                at = 2 * at + 1 + (row[f[at]] > t[at])
            total += v[at - len(f)]
        return total

    assert np.allclose(model.raw(x[:50]), [walked(r) for r in x[:50]])
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    assert quality_classifier.fit(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3
    assert (quality_classifier.fit(x, np.ones(400)).score(x) > 0.99).all()


def plain_fit(x, y, trees, depth, rate, bins, l2, least):
    """The boosting by its definition: every limit of every feature is tried at every node, one after another."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    raw, limits = np.full(len(y), math.log(share / (1 - share))), [sorted(set(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]))) for j in range(x.shape[1])]

    def grow(rows, level, g, h):
        if level == depth:
            return lambda r, v=rate * g[rows].sum() / (h[rows].sum() + l2): v
        part = lambda i: g[i].sum() ** 2 / (h[i].sum() + l2)
        best, chosen = 1e-6, None
        for j, edges in enumerate(limits):
            for e in edges:
                left, right = [i for i in rows if x[i, j] <= e], [i for i in rows if x[i, j] > e]
                if h[left].sum() >= least and h[right].sum() >= least and (gain := part(left) + part(right) - part(rows)) > best + 1e-12:
                    best, chosen = gain, (j, e, left, right)
        if chosen is None:
            return grow(rows, level + 1, g, h)
        j, e, left, right = chosen
        low, high = grow(left, level + 1, g, h), grow(right, level + 1, g, h)
        return lambda r: low(r) if r[j] <= e else high(r)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        tree = grow(list(range(len(y))), 0, y - p, p * (1 - p))
        raw = raw + np.array([tree(r) for r in x])
    return raw


def test_boosting_against_a_plain_version():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 4))
    y = ((x[:, 0] > 0.2) ^ (x[:, 2] * x[:, 1] > 0)).astype(float)
    model = quality_classifier.fit(x, y, trees=4, depth=3, rate=0.3, bins=8, l2=1.0, min_weight=2.0)
    assert model.raw(x) == pytest.approx(plain_fit(x, y, 4, 3, 0.3, 8, 1.0, 2.0))


def test_classifier_on_held_out_documents(spark):
    from tests.conftest import SF

    docs, labels = (spark.read.parquet(f"{SF.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    out = quality_classifier.score_quality(docs, quality_classifier.train(docs, labels)).toPandas().merge(labels.toPandas(), on="doc_id")
    held = out[out.held_out]
    assert (held.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in held.doc_id]).all()
    assert (held.predicted == held.quality).mean() > 0.92 and (held[held.quality == 1].predicted == 1).mean() > 0.97


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "a b"), (3, "x" * 200_000)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = quality_classifier.score_quality(docs, quality_classifier.train(docs, none)).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert quality_classifier.score_quality(spark.createDataFrame([], DOCS), quality_classifier.train(docs, none)).count() == 0


# Language model


def plain_tree(trained, depth, least, n, v):
    """Counts of all sequences, and probabilities by definition: dictionaries and recursion."""
    base = lambda c: (c + 0.5) / (n + 0.5 * (v + 1))
    singles = Counter(w for t in trained for w in [*t, "</>"])
    grams = {}
    frequent = {(w,) for w, c in singles.items() if c >= least} | {("</>",), ("<>",)}
    total = Counter({(w,): c for w, c in singles.items()})
    total[("<>",)] = len(trained)
    for k in range(2, depth + 2):
        found = Counter()
        for t in trained:
            s = ["<>", *t, "</>"]
            for i in range(len(s) - k + 1):
                g = tuple(s[i : i + k])
                if g[:-1] in frequent and g[-1:] in frequent and g[-1] != "<>":
                    found[g] += 1
        grams[k] = {g: c for g, c in found.items() if c >= least}
        frequent |= set(grams[k])
        total.update(grams[k])
    kept: dict = {}

    def p(w, context):
        while context and context not in kept:
            context = context[1:]
        if not context:
            return base(singles.get(w, 0))
        if w in kept[context][0]:
            return kept[context][0][w]
        return kept[context][1] * p(w, context[1:])

    for k in range(2, depth + 2):
        new = {}
        for g, c in grams[k].items():
            context, w = g[:-1], g[-1]
            before, all_ = p(w, context[1:]), total[context]
            ratio = c / all_ / before
            if ratio >= suffix_tree_lm.MIN_RATIO and c * math.log(ratio) >= suffix_tree_lm.MIN_GAIN:
                new.setdefault(context, {})[w] = (c + suffix_tree_lm.PRIOR * before) / (all_ + suffix_tree_lm.PRIOR)
        add = {}
        for context, ps in new.items():
            was = sum(p(w, context[1:]) for w in ps)
            add[context] = ps, max(1 - sum(ps.values()), 1e-12) / max(1 - was, 1e-12)
        kept.update(add)
    return p, base, singles, kept


def test_suffix_tree_against_a_plain_one(spark):
    draw = random.Random(3)
    lines = ["all rights are reserved here", "to be or not to be", "one two three"]
    rows = [(i, " ".join(itertools.chain(*[draw.choice([[draw.choice(lines)], [f"w{draw.randrange(30)}"], ["The"]]) for _ in range(12)]))) for i in range(120)] + [(200, None), (201, "never seen before")]
    out = {r.doc_id: r for r in suffix_tree_lm.score_texts(spark.createDataFrame(rows, DOCS), min_count=5).collect()}
    split = {i: (t or "").lower().split() for i, t in rows}
    trained = [t for i, t in split.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    n, v = sum(len(t) + 1 for t in trained), len({w for t in trained for w in t}) + 1
    p, base, singles, kept = plain_tree(trained, 3, 5, n, v)
    assert any(len(c) == 3 for c in kept)
    for i, t in split.items():
        s = [*t, "</>"]
        want_base = sum(math.log10(base(singles.get(w, 0))) for w in s)
        want = sum(math.log10(p(w, tuple(["<>", *t][max(0, j - 2) : j + 1]))) for j, w in enumerate(s))
        assert (out[i].n_tokens, out[i].train_tokens) == (len(s), n)
        assert out[i].n_known == sum(singles.get(w, 0) > 0 for w in s)
        assert out[i].base_score == pytest.approx(want_base) and out[i].score == pytest.approx(want)
    context = next(c for c in kept if len(c) == 2)
    assert sum(p(w, context) for w in singles) + p("unseen", context) == pytest.approx(1)


def test_contexts_of_the_least_count_stay_in_a_large_input(spark, monkeypatch):
    # 1.4 million tokens: a share of 5e-6 of them would be 7, more than a phrase has that comes 6 times
    rows = [(i, "to and fro " * 1000) for i in range(600)] + [(1000 + i, "to be fair") for i in range(8)]
    trained = sum(zlib.crc32(str(1000 + i).encode()) % 5 != 1 for i in range(8))
    assert 5 <= trained < 7
    df = spark.createDataFrame(rows, DOCS)
    out = {r.doc_id: r for r in suffix_tree_lm.score_texts(df).collect()}
    assert math.ceil(out[1000].train_tokens * 5e-6) > trained
    # its words are certain after their contexts, save for the smoothing
    assert out[1000].score > -4 and out[1000].base_score < -14
    # many blocks and buckets, and hot sequences dealt with what follows, give the same
    for name, value in (("BLOCK_TOKENS", 20_000), ("BUCKET_TOKENS", 10_000), ("HOT_COUNT", 1_000), ("HOT_SHARE", 0.02)):
        monkeypatch.setattr(suffix_tree_lm, name, value)
    for r in suffix_tree_lm.score_texts(df.repartition(3)).collect():
        assert r.score == pytest.approx(out[r.doc_id].score) and r.base_score == pytest.approx(out[r.doc_id].base_score) and r.n_known == out[r.doc_id].n_known


def test_language_model_edges(spark):
    rows = [(None, "a b"), (1, ""), (1, ""), (2, "z" * 100_000)]
    out = suffix_tree_lm.score_texts(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == 4 and all(math.isfinite(r.score) for r in out)
    assert suffix_tree_lm.score_texts(spark.createDataFrame([], DOCS)).count() == 0


# Fingerprints


def generalised(a, b):
    x, y = (dict(zip(*fingerprints.weights(t), strict=True)) for t in (a, b))
    keys = set(x) | set(y)
    return sum(min(x.get(k, 0), y.get(k, 0)) for k in keys) / sum(max(x.get(k, 0), y.get(k, 0)) for k in keys)


def test_collisions_estimate_generalised_jaccard():
    sampler, wide = fingerprints.Sampler(), fingerprints.Sampler(1024, 5_000)
    some = texts(12, 4)
    for a, b in zip(some, some[1:], strict=False):
        b = a[: len(a) // 2] + b
        assert fingerprints.likeness(wide.signature(a), wide.signature(b)) == pytest.approx(generalised(a, b), abs=0.06)
    assert (sampler.signature(some[0]) == fingerprints.Sampler().signature(some[0])).all()


def test_documents_meet_their_next(spark):
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts(100, 5))]
    out = {r.doc_id: r for r in fingerprints.compare_with_next(spark.createDataFrame(rows, DOCS).repartition(6)).collect()}
    ordered = sorted(rows)
    sampler = fingerprints.Sampler()
    for (i, a), (_, b) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(a) // 2
        changed = a[: len(a) - half] + b[:half]
        assert out[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest() and out[i].n_chars == len(a)
        assert out[i].fingerprint == fingerprints.written(sampler.signature(a))
        assert out[i].near_next == fingerprints.likeness(sampler.signature(a), sampler.signature(b))


def test_texts_of_many_words_are_sampled_in_slices(monkeypatch):
    text = " ".join(f"w{i}" for i in range(30_000))
    sampler = fingerprints.Sampler()
    got = sampler.signature(text)
    assert sampler.table.shape[1] <= fingerprints.WORD_CACHE
    monkeypatch.setattr(fingerprints, "SLICE_WORDS", 1 << 20)
    assert (fingerprints.Sampler(cache=1 << 20).signature(text) == got).all()


def test_fingerprint_edges(spark):
    rows = [(1, None), (1, ""), (None, "é𝒳 a"), (2, "x " * 100_000), (2, "x " * 100_000)]
    out = fingerprints.compare_with_next(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == 5 and {r.n_chars for r in out} == {0, 4, 200_000}
    assert len({r.fingerprint for r in out if r.n_chars == 200_000}) == 1
    assert fingerprints.compare_with_next(spark.createDataFrame([(1, "only one")], DOCS)).first().near_next == 1.0
    assert fingerprints.compare_with_next(spark.createDataFrame([], DOCS)).count() == 0
    assert fingerprints.fingerprints(spark.createDataFrame(rows, DOCS)).count() == 5


# Segmentations


@pytest.fixture(scope="module")
def lattices():
    with open(sentence_pieces.MODEL, "rb") as file:
        return sentence_pieces.Lattices(sentence_pieces.Vocabulary(file.read()))


def ways(v, chunk):
    """All segmentations of a chunk, by their definition, as (ids, ln weight)."""
    text = {bytes(d): i for i, d in enumerate(v.data) if d and math.isfinite(v.log[i]) and i not in v.byte}

    def go(rest):
        if not rest:
            yield (), 0.0
        for k in range(1, len(rest) + 1):
            if (i := text.get(rest[:k].replace(sentence_pieces.BLANK, " ").encode())) is not None:
                for ids, w in go(rest[k:]):
                    yield (i, *ids), w + v.log[i]

    return dict(go(chunk))


def test_lattice_weights_against_enumeration(lattices):
    for chunk in ["▁hello", "▁the", "▁▁▁a", "▁Zügen."]:
        all_ = ways(lattices.v, chunk)
        n = lattices.numbers([chunk])[0]
        assert lattices.ways[lattices.start[n]] == len(all_)
        assert lattices.total[n] == pytest.approx(np.logaddexp.reduce(list(all_.values())))


def test_first_samples_and_inclusion_follow_the_distribution(lattices):
    text, runs = "on to", 4000
    all_ = {a + b: x + y for a, x in ways(lattices.v, "▁on").items() for b, y in ways(lattices.v, "▁to").items()}
    z = np.logaddexp.reduce(list(all_.values()))
    first, seen, weight = Counter(), Counter(), Counter()
    for k in range(0, runs, 500):
        for found in sentence_pieces.encode_slice(lattices, [text] * 500, list(range(k * 7919, k * 7919 + 500)), 2):
            assert len(found) == 2 and len({tuple(f[0].tolist()) for f in found}) == 2 and found[0][2] > found[1][2]
            first[tuple(found[0][0].tolist())] += 1
            for ids, log, _, inclusion in found:
                key = tuple(ids.tolist())
                assert log == pytest.approx(all_[key] - z, abs=1e-6)
                seen[key] += 1
                weight[key] += 1 / math.exp(inclusion) / runs
    for key, log in all_.items():
        p = math.exp(log - z)
        assert first[key] / runs == pytest.approx(p, abs=4 * math.sqrt(p / runs) + 1e-3)
        if p > 0.05:  # weighted by the inverse of its inclusion score, each counts once on average
            assert weight[key] == pytest.approx(1, abs=0.25)


def test_few_segmentations_are_all_found(lattices):
    found = sentence_pieces.encode_slice(lattices, ["at", "", "é"], [1, 2, 3], 50)
    for text, each in zip(["at", "", "é"], found, strict=True):
        want = ways(lattices.v, sentence_pieces.BLANK + text) if text else {(): 0.0}
        assert {tuple(f[0].tolist()) for f in each} == set(want) and all(f[3] == 0 for f in each)


def test_faint_states_change_nothing(lattices, monkeypatch):
    """The search with and without the states that it leaves out."""
    long = [" ".join(texts(1, seed, 150)) for seed in range(40, 60)]
    seeds = list(range(900, 920))
    short = [[(tuple(f[0].tolist()), f[1], f[2]) for f in each] for each in sentence_pieces.encode_slice(lattices, long, seeds, 3)]
    monkeypatch.setattr(sentence_pieces, "FAINT", math.inf)
    whole = [[(tuple(f[0].tolist()), f[1], f[2]) for f in each] for each in sentence_pieces.encode_slice(lattices, long, seeds, 3)]
    assert short == whole and all(len({f[0] for f in each}) == 3 for each in short)


def test_encoding_round_trips(spark):
    odd = ["", None, "  two  blanks ", "tab\tand\nlines\r\n", "▁ literal ▁x", "emoji 🤦🏽 日本語 العربية", "\x00\x7f", "a" * 5000, " ".join(f"w{i}" for i in range(5000)), " "]
    df = spark.createDataFrame([(i, t, "own") for i, t in enumerate(odd)] + [(None, "x", "y"), (0, "", "own")], "doc_id long, text string, ids string")
    out = sentence_pieces.encode(df, keep=["doc_id", "text", "ids"])
    assert out.columns.count("ids") == 1 and out.where("not round_trip").count() == 0
    back = sentence_pieces.decode(out)
    assert back.where("decoded != coalesce(text, '')").count() == 0
    assert sorted(map(str, sentence_pieces.encode(df.repartition(5)).collect())) == sorted(map(str, sentence_pieces.encode(df).collect()))
    assert sentence_pieces.encode(spark.createDataFrame([], DOCS)).count() == 0


# Joins


def plain_components(rows, n, percent):
    sets = {}
    for i, t in rows:
        ws = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(ws[j : j + n]) for j in range(max(1, len(ws) - n + 1))) if ws else frozenset()
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, j in itertools.combinations(sorted(sets), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b) and root(i) != root(j):
            least[max(root(i), root(j))] = min(root(i), root(j))
    return {i: (len(s), root(i)) for i, s in sets.items()}


def near_copies(seed, n=120):
    draw = random.Random(seed)
    base = [t.split() for t in texts(8, seed, 200)]
    rows = []
    for i in range(n):
        ws = list(draw.choice(base)) if draw.random() < 0.8 else texts(1, seed * 1000 + i)[0].split()
        for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 6])):
            ws[draw.randrange(len(ws))] = f"new{draw.randrange(10**6)}"
        rows.append((i, draw.choice([" ", "\n"]).join(ws).upper() if draw.random() < 0.2 else " ".join(ws)))
    return rows + [(1000, "a b"), (1001, "A  b"), (1002, "a"), (1003, ""), (1004, None)]


@pytest.mark.parametrize(("seed", "n", "percent"), [(1, 3, 90), (2, 5, 80)])
def test_join_finds_every_link(spark, seed, n, percent):
    rows = near_copies(seed)
    out = ngram_join.join_ngrams(spark.createDataFrame(rows, DOCS), n, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == plain_components(rows, n, percent)


def test_prefix_size_is_enough():
    for percent in (80, 90, 100):
        for n in range(1, 400):
            assert n - ngram_join.prefix_size(n, percent) < math.ceil(percent * n / 100) <= n


def test_one_of_each_group_stays(spark):
    rows = near_copies(3)
    want = plain_components(rows, 5, 80)
    kept = [r.doc_id for r in ngram_join.one_of_each(spark.createDataFrame(rows + [(0, rows[0][1])], DOCS)).collect()]
    assert sorted(kept) == sorted(i for i, (n, c) in want.items() if i == c)


def test_join_edges(spark):
    rows = [(None, "a b c"), (None, "a b c"), (5, "a b c"), (6, None), (7, "x" * 100_000)]
    out = ngram_join.join_ngrams(spark.createDataFrame(rows, DOCS), 3, 90).collect()
    assert len(out) == 5 and {r.component_id for r in out if r.n_shingles and r.doc_id != 7} == {5}
    assert ngram_join.join_ngrams(spark.createDataFrame([], DOCS), 3, 90).count() == 0


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 300)]
    out = {r.node: r.comp for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {out[i] for i in range(61)} == {0} and {out[i] for i in (100, 200, 300)} == {100}
