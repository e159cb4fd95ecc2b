"""Rules, lines, URLs, mixing, chats: small cases with known results, and edge cases."""

import random
from collections import Counter
from urllib.parse import quote

import numpy as np
import pytest
import zstandard

from loam.llm import chat_views, common, fingerprints, line_dedup, ngram_join, quality_classifier, quality_rules, sentence_pieces, source_mix, suffix_tree_lm, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve qua plo sem gru".split()
EDGES = [
    (1, None, "en", "a", None),
    (2, "", "en", None, 0),
    (3, " \n\t ", None, "a", 4),
    (3, " \n\t ", None, "a", 4),
    (None, "one two", "en", "b", 7),
    (4, "x" * 300_000, "en", "a", 300_000),
    (5, " ".join(f"w{i}" for i in range(30_000)), "en", "a", 1),
]


def edges(spark):
    return spark.createDataFrame(EDGES, DOCS).withColumn("kept", common.F.lit("own"))


def empty(spark):
    return spark.createDataFrame([], DOCS)


# Quality rules


def plain_repeats(ws, n=5):
    seen = Counter(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
    covered = set()
    for i in range(len(ws) - n + 1):
        if seen[tuple(ws[i : i + n])] > 1:
            covered.update(range(i, i + n))
    return len(covered)


def test_repeated_words_against_brute_force():
    import numpy as np

    draw = random.Random(1)
    for _ in range(200):
        ws = [draw.choice("abc") for _ in range(draw.randrange(60))]
        ids = np.array([ord(w) for w in ws], np.int64)
        assert quality_rules.repeated_words(ids, 5) == plain_repeats(ws)


def test_quality_rules_count_and_judge(spark):
    draw = random.Random(7)
    good = " ".join("".join(draw.choices(SYLLABLES, k=draw.randrange(1, 4))) for _ in range(120))
    rows = [(1, good), (2, "ab $% <|\nab $% <|\nÉ é\n\n"), (3, "spam " * 400), (4, " ".join(random.Random(5).choices("qwertyuiopasdfghjklzxcvbnmQWERTYUIOP0123456789", k=9000)).replace(" ", "") + " a b c d e f g h i j k")]
    out = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].kept and not out[1].base_failed and out[1].reason is None
    assert (out[2].n_words, out[2].word_chars, out[2].n_symbols, out[2].n_dup_lines, out[2].base_failed) == (8, 14, 8, 1, True)
    assert out[3].base_failed and out[3].reason == "repeats" and out[3].n_repeat_words == 400
    assert not out[4].base_failed and out[4].reason == "incompressible"
    assert out[1].ratio == len(zstandard.ZstdCompressor(level=3).compress(good.encode())) / len(good.encode())


def test_chunk_rule():
    draw, pack = random.Random(1), zstandard.ZstdCompressor(level=3)
    prose = lambda n: " ".join("".join(draw.choices(SYLLABLES, k=draw.randrange(1, 5))) for _ in range(n))
    data = prose(2000).encode()
    assert quality_rules.chunks(data[:1024], 1024) == []
    assert quality_rules.chunks(data[:3072], 1024) == [data[:1024], data[1024:2048], data[2048:3072]]
    assert quality_rules.chunks(data[:2500], 1024) == [data[:1024], data[1024:2048], data[1476:2500]]
    # junk behind whole chunks is seen, as the last chunk reaches back from the end
    rules = quality_rules.Rules(bands=(quality_rules.Band(float("inf"), 0.0, 9.0),), max_bad_chunks=0.3)
    junk = bytes(draw.choices(range(33, 126), k=1000))
    assert quality_rules.judge(data[:1200], rules, pack)[7:] == (2, 0, None, True)
    assert quality_rules.judge(data[:1200] + b" " + junk, rules, pack)[-2:] == ("chunks", False)
    for i in range(50):
        text = data[i * 37 : i * 37 + draw.randrange(100, 4000)] + (junk if i % 3 == 0 else b"")
        parts = [text[k : k + 1024] for k in range(0, len(text), 1024) if k + 1024 <= len(text)] if len(text) > 1024 else []
        parts += [text[-1024:]] if parts and len(text) % 1024 else []
        bad = [not rules.chunk_low <= len(pack.compress(x)) / 1024 <= rules.chunk_high for x in parts]
        got = quality_rules.judge(text, rules, pack)
        assert got[7:9] == (len(parts), sum(bad)) and (got[9] == "chunks") == (not got[5] and sum(bad) > 0.3 * len(parts))


def test_quality_rules_edges(spark):
    out = quality_rules.quality_rules(edges(spark)).collect()
    assert len(out) == len(EDGES) and not any(r.kept for r in out if r.doc_id != 5)
    assert [c for c in quality_rules.quality_rules(edges(spark)).columns].count("kept") == 1
    assert quality_rules.quality_rules(empty(spark)).count() == 0


# Line dedup


def test_line_dedup_cuts_what_is_on_most_pages(spark):
    rows = [(i, f"Menu\n own line {i} \n\nFooter {i % 2}", "en", "a", 0) for i in range(10)] + [(100 + i, "Menu", "en", "b", 0) for i in range(8)]
    out = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS), max_ratio=0.5).collect()}
    assert out[3].text == " own line 3 \n\nFooter 1" and out[3].n_lines == 4 and out[3].n_dropped == 1
    # eight copies of one page are one page, whose line repeats nothing
    assert out[100].text == "Menu"


def test_production_ratio_and_whole_pages(spark):
    rows = [(i, ("Sign up here\n" if i < 9 else "") + f"own line {i}\nand another {i}", "en", "a", 0) for i in range(100)]
    rows += [(200 + i, ("a saying of some pages\n" if i < 6 else "") + f"own line {i} of b", "en", "b", 0) for i in range(100)]
    rows += [(400 + i, "Sign up here\nx", "en", "a", 0) for i in range(1)]
    df = spark.createDataFrame(rows, DOCS)
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert out[3] == "own line 3\nand another 3" and out[203].startswith("a saying") and out[400] == "x"
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(df, max_loss=0.7).collect()}
    assert out[3] == "own line 3\nand another 3" and out[400] == "Sign up here\nx"


def test_line_dedup_by_shuffle_agrees(spark, monkeypatch):
    rows = [(i, f"Menu\nline {i}", "en", random.Random(i).choice(["a", None]), 0) for i in range(60)]
    df = spark.createDataFrame(rows, DOCS)
    one = sorted(line_dedup.dedup_lines(df).collect(), key=str)
    monkeypatch.setattr(line_dedup, "MAX_BROADCAST_LINES", 0)
    assert sorted(line_dedup.dedup_lines(df.repartition(7)).collect(), key=str) == one
    assert all("Menu" not in r.text for r in one)


def test_line_dedup_edges(spark):
    out = line_dedup.dedup_lines(edges(spark)).collect()
    assert len(out) == len(EDGES)
    null = next(r for r in out if r.doc_id == 1)
    assert null.text is None and null.n_lines == 0 and null.n_dropped == 0
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


# URLs

URLS = [
    ("https://WWW.Example.com/en/1?x=1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://a.example.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
    ("http://a.example.com/fr/1#t", "a.example.com", "/fr/1", "com/", "allow"),
    ("https://x.net/es/9", "x.net", "/es/9", "net/es/", "block"),
    ("https://notcom/es/9", "notcom", "/es/9", None, None),
    ("https://x.com", "x.com", "", None, None),
    ("https://x.com?a=/b", "x.com", "", None, None),
    ("no address", "", "", None, None),
    (None, "", "", None, None),
    ("", "", "", None, None),
]


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u[0], "old") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    out = {r.page_id: r for r in url_filter.filter_urls(df).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, rule)
        assert out[i].verdict == verdict if rule else out[i].verdict in ("allow", "block")


def test_url_models_tell_classes_apart(spark):
    draw = random.Random(2)
    made = lambda letters: "".join(draw.choice(letters) for _ in range(12))
    rows = [(i, f"https://{made('abc')}.com/{made('abc')}") for i in range(80)] + [(100 + i, f"https://{made('xyz')}.net/es/{made('xyz')}") for i in range(80)]
    rows += [(300 + i, f"https://{made('abc')}.org/{made('abc')}") for i in range(20)] + [(400 + i, f"https://{made('xyz')}.org/{made('xyz')}") for i in range(20)]
    out = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert all(r.verdict == ("allow" if r.page_id < 400 else "block") for r in out if r.page_id >= 300)


def test_url_scores_against_a_plain_model(spark, monkeypatch):
    import math

    monkeypatch.setattr(url_filter, "MIN_CONTEXT", 3)
    draw, d, m, k = random.Random(5), url_filter.DEPTH, url_filter.PRIOR, len(url_filter.ALPHABET)
    rows = [(draw.choice(["allow", "block"]), "".join(draw.choice("ab/1É") for _ in range(draw.randrange(9)))) for _ in range(40)]
    grams = Counter()
    for label, rest in rows:
        s = "^" * d + "".join("0" if c.isdigit() else c if c in url_filter.ALPHABET else "*" for c in rest) + "$"
        grams.update((label, s[i : i + d + 1]) for i in range(len(s) - d))
    asked = sorted({g for _, g in grams}) + ["^^^^^z", "ababaq", "zzzzzz"]
    counts = [(g, grams["allow", g], grams["block", g]) for g in {g for _, g in grams}]
    got = {r.gram: r.llr for r in url_filter.gram_scores(spark.createDataFrame(counts, "gram string, a long, r long"), spark.createDataFrame([(g,) for g in asked], "gram string")).collect()}

    def p(label, g):
        n = lambda f, of=(label,): sum(v for (x, h), v in grams.items() if x in of and f(h))
        out = (n(lambda h: h[-1] == g[-1]) + 1) / (n(lambda h: True) + k)
        for size in range(1, d + 1):
            context = g[-1 - size : -1]
            same = lambda h, context=context, size=size: h[-1 - size : -1] == context
            if n(same, ("allow", "block")) >= 3:
                out = (n(lambda h, size=size: h[-1 - size :] == g[-1 - size :]) + m * out) / (n(same) + m)
        return out

    assert len(got) == len(asked)
    for g in asked:
        assert abs(got[g] - 1e6 * (math.log(p("allow", g)) - math.log(p("block", g)))) <= 1


def test_url_edges(spark):
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    one = spark.createDataFrame([(1, "https://a.org/" + "x" * 50_000), (1, "https://a.org/" + "x" * 50_000)], "page_id long, url string")
    assert [r.verdict for r in url_filter.filter_urls(one).collect()] == ["allow", "allow"]  # nothing to learn from


# Mixing


def plain_mix(rows, weights=(5, 2, 1), budget=1.5, cap=2):
    sizes = Counter()
    for r in rows:
        sizes[r[1]] += r[2]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    left, open_, target = budget * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if cap * sizes[s] <= w[s] * level}
        if not full:
            target.update({s: w[s] * level for s in open_})
            break
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= full
    return sizes, target


@pytest.mark.parametrize("seed", range(3))
def test_mix_reaches_targets(spark, seed, monkeypatch):
    monkeypatch.setattr(source_mix, "BUCKET_ROWS", 5)
    draw = random.Random(seed)
    rows = [(i, draw.choice(["a", "b", "ß", "z", None, "a", "a"]), draw.choice([0, 1, 7, 50])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    out = source_mix.mix_sources(df, "size").collect()
    sizes, target = plain_mix(rows)
    taken = Counter()
    for r in out:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) < 1e-6
    assert len(out) == 300 and all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in sizes)
    again = source_mix.mix_sources(df.repartition(5), "size").collect()
    assert sorted(again, key=str) == sorted(out, key=str)


def test_mix_repeats_rows(spark):
    rows = [(i, "w " * 4 + f"\n end{i}", "en", "a" if i < 8 else "b", 0) for i in range(10)]
    mixed = source_mix.mixed_documents(spark.createDataFrame(rows, DOCS))
    want = sum(r.taken for r in mixed.collect())
    made = source_mix.repetitions(mixed)
    assert made.columns == ["doc_id", "text", "lang", "source", "n_chars", "size"]
    assert sum(len(r.text.split()) for r in made.collect()) == want


def test_mix_edges(spark):
    out = source_mix.mixed_documents(edges(spark)).collect()
    assert len(out) == len(EDGES) and {r.size for r in out if r.doc_id in (1, 2, 3)} == {0}
    assert source_mix.mixed_documents(empty(spark)).count() == 0
    assert source_mix.repetitions(source_mix.mixed_documents(edges(spark))).where("text is null").count() <= 1


# Chats

TURNS = "conv_id long, turn long, role string, text string"


def test_every_speaker_is_once_the_assistant(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "ann", "Hi <|end|>"), (1, 2, "bob", "Ho"), (1, 3, "ann", None), (2, 0, "system", "alone"), (None, 0, None, "x")]
    out = chat_views.perspectives(spark.createDataFrame(rows, TURNS)).collect()
    assert {(r.conv_id, r.speaker) for r in out} == {(1, "ann"), (1, "bob"), (None, "?")}
    ann = next(r for r in out if r.speaker == "ann")
    assert ann.rendered == "<|system|>\nBe brief.<|end|>\n<|assistant|>\nHi < |end|><|end|>\n<|user name=bob|>\nHo<|end|>\n<|assistant|>\n<|end|>\n"
    assert [ann.rendered[s.start : s.end] for s in ann.spans] == ["Hi < |end|><|end|>\n", "<|end|>\n"]


def plain_views(rows):
    """Renderings by their definition: sort, then one pass for each speaker."""
    out = {}
    for conv in {r[0] for r in rows}:
        name = lambda r: "?" if r is None else quote(r, safe="-_.").replace("~", "%7E")
        turns = sorted([(t is None, t or 0, name(role), (text or "").replace("<|", "< |")) for c, t, role, text in rows if c == conv])
        for speaker in {t[2] for t in turns} - {"system"}:
            text, spans = "", []
            for _, _, who, said in turns:
                text += "<|system|>\n" if who == "system" else "<|assistant|>\n" if who == speaker else f"<|user name={who}|>\n"
                if who == speaker:
                    spans.append((len(text), len(text) + len(said) + len(chat_views.END)))
                text += said + chat_views.END
            out[conv, speaker] = text, spans
    return out


def test_dialogues_against_a_plain_version(spark):
    draw = random.Random(2)
    roles = ["a b", "a_b", "Ан", "Ян", "system", None, "?", "x+*~"]
    rows = [(c, draw.choice([draw.randrange(20), None]), draw.choice(roles), draw.choice(["same", None, "<|x", f"t{i}"])) for c in (1, 2, None) for i in range(40)]
    rows += [(9, 5, "hot", "again")] * 700 + [(9, 5, draw.choice(roles), f"tie {i}") for i in range(300)]
    want, df = plain_views(rows), spark.createDataFrame(rows, TURNS)
    for block in (4096, 64):
        out = {}
        for r in sorted(chat_views.perspectives(df.repartition(5), block_turns=block).collect(), key=lambda r: r.block):
            text, spans = out.get((r.conv_id, r.speaker), ("", []))
            assert r.begin == len(text) and r.n_turns <= block
            out[r.conv_id, r.speaker] = text + r.rendered, spans + [(s.start + r.begin, s.end + r.begin) for s in r.spans]
        assert out == want
    assert chat_views.perspectives(spark.createDataFrame([], TURNS)).count() == 0


# Names


@pytest.mark.parametrize(
    ("operator", "names"),
    [
        (lambda df: line_dedup.dedup_lines(df), ["cut_host", "cut_lines", "kept_lines", "host", "line", "n_lines"]),
        (lambda df: quality_rules.quality_rules(df), ["own_text", "OWN_TEXT_", "n_words", "reason"]),
        (lambda df: url_filter.filter_urls(df.withColumnRenamed("text", "url")), ["rest", "raw_host", "norm", "label", "gram", "host", "score"]),
        (lambda df: source_mix.mix_sources(df, "n_chars"), ["of", "size_", "hash", "s", "es", "edge", "extra", "before", "buckets", "bucket", "whole", "source_size"]),
        (lambda df: ngram_join.one_of_each(df), ["kept_id", "kept_k1", "kept_k2", "node", "n"]),
        (lambda df: ngram_join.join_ngrams(df), ["node", "n", "hash", "comp", "prefix"]),
        (lambda df: sentence_pieces.encode(df, keep=df.columns, samples=1), ["own_key", "own_text", "ids", "sample"]),
        (lambda df: quality_classifier.score_quality(df, quality_classifier.fit(np.zeros((0, quality_classifier.N_STATISTICS)), np.zeros(0))), ["score", "held_out", "predicted", "x"]),
        (lambda df: suffix_tree_lm.score_texts(df), ["block", "tokens", "held_out", "score", "key", "n"]),
        (lambda df: fingerprints.compare_with_next(df), ["part", "edge", "fingerprint", "next"]),
    ],
)
def test_columns_with_clashing_names(spark, operator, names):
    rows = [(i, f"one two three four five six {i % 3}\nx{i}", "en", "ab"[i % 2], 9) for i in range(12)]
    plain = spark.createDataFrame(rows, DOCS)
    clashing = plain.select("*", *[common.F.lit("own").alias(n) for n in names])
    out, want = operator(clashing), operator(plain)
    assert sorted(map(str, out.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert out.count() == want.count()


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("Context", (), {"master": "spark://host:7077", "getConf": staticmethod(lambda: Session.conf)})

    with pytest.raises(ValueError):
        common.shared_dir(Session)
