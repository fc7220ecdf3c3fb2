"""The operators against plain Python, on awkward small tables and the smallest test tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, `key` string, `n` int"
PASSAGE = "the committee met on tuesday and agreed that nothing in this passage would be changed by anyone at all before friday"


def rows_of(*texts, source=lambda i: f"s{i % 3}", first=0):
    return [(first + i, t, "en", source(i), len(t or ""), "x", "y", 1) for i, t in enumerate(texts)]


def awkward():
    r = random.Random(5)
    words = ["alpha", "Beta", "gamma,", "déjà", "日本", "x", "!!", "##", "1.2.3.4", "a@b.co", "+1 (555) 010-9999", "4111 1111 1111 1111"]
    texts = [None, "", " ", "\n\n", "\n" + PASSAGE + "\n", PASSAGE, PASSAGE, PASSAGE.upper(), "a" * 3000, " ".join(["spam"] * 400),
             "word " * 4, "one two three four", "one two three four", "\x00\x1c  odd", "9" * 9000, "a." * 5000, "-" * 3000 + "@b.c"]
    texts += [" ".join(r.choice(words) for _ in range(r.randint(0, 200))) + "\n" + (PASSAGE if i % 3 == 0 else "") for i in range(40)]
    base = " ".join(f"w{r.randint(0, 999)}" for _ in range(300))
    texts += [base] + [" ".join("new" if k == 7 * i else w for k, w in enumerate(base.split())) for i in range(1, 9)]
    texts += [" ".join(f"v{r.randint(0, 99999)}" for _ in range(30_000))]
    return rows_of(*texts, source=lambda i: None if i % 4 == 3 else f"s{i % 4}")


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(awkward(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_mixing(docs, empty):
    from carelens.llm.common import OWN
    from carelens.llm.op01_mixing import mix, mix_documents
    got = mix(docs).collect()
    want = brute.mix_targets([(r[0], r[1], r[3]) for r in awkward()])
    source = {r[0]: r[3] for r in awkward()}
    taken = {}
    for r in got:
        s = source[r[f"{OWN}id"]]
        assert r[f"{OWN}source_size"] == want[s][0] and r[f"{OWN}target"] == pytest.approx(want[s][1])
        assert 0 <= r[f"{OWN}taken"] <= 3 * r[f"{OWN}size"]
        taken[s] = taken.get(s, 0) + r[f"{OWN}taken"]
    assert len(got) == len(awkward())
    assert all(abs(taken[s] - t) <= 130 for s, (_, t) in want.items())
    again = {(r[f"{OWN}id"], r[f"{OWN}taken"]) for r in mix(docs.repartition(5)).collect()}
    assert again == {(r[f"{OWN}id"], r[f"{OWN}taken"]) for r in got}
    made = mix_documents(docs)
    assert made.columns == docs.columns
    words = {r.doc_id: r.n for r in made.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(brute.WORD.pattern))).alias("n")).collect()}
    assert words == {r[f"{OWN}id"]: r[f"{OWN}taken"] for r in got if r[f"{OWN}taken"]}
    assert mix(empty).count() == 0 and mix_documents(empty).count() == 0


def test_seats_are_the_highest_quotients(spark):
    from carelens.llm.op01_mixing import apportion
    r = random.Random(3)
    for _ in range(6):
        parts = [(i, float(r.randint(1, 9)), r.randint(0, 40)) for i in range(r.randint(1, 12))]
        total = r.randint(0, sum(c for *_, c in parts))
        df = spark.createDataFrame([(i, w, c, total) for i, w, c in parts], "k int, weight double, cap long, total long")
        quotients = sorted(((-w / (2 * j - 1), i) for i, w, c in parts for j in range(1, c + 1)))[:total]
        want = {i: sum(k == i for _, k in quotients) for i, *_ in parts}
        assert {x.k: x.seats for x in apportion(df, [], ["k"]).collect()} == want


def test_suffix_dedup(docs, empty):
    from carelens.llm.op02_lpf import longest_previous, without_repeats
    got, want = by_id(without_repeats(docs)), brute.lpf_removal([r[:2] for r in awkward()])
    assert {d: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for d, r in got.items()} == want
    assert without_repeats(empty).count() == 0
    r = random.Random(1)
    pieces = [bytes(r.choice(b"ab") for _ in range(r.randint(100, 168))) for _ in range(30)] + [b"a" * 150, b"\0" * 168]
    pieces += [pieces[3][5:110], pieces[7]]
    seen, expect = set(), []
    for p in pieces:
        expect.append([p[i:i + 100] in seen or seen.add(p[i:i + 100]) for i in range(len(p) - 99)])
    assert [[bool(x) for x in f] for f in longest_previous(pieces)] == [[bool(x) for x in f] for f in expect]


def test_suffix_dedup_spreads_a_crowded_owner(spark, tmp_path, monkeypatch):
    from carelens.llm import op02_lpf as p
    r, phrase, most = random.Random(2), "licensed under the terms that are printed at the foot of this page only", []
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(7))
    tails = [f"{word()} {word()} {word()} {word()}" for _ in range(5)]
    texts = [" ".join([word() for _ in range(12)] + [phrase, r.choice(tails)] + [word() for _ in range(12)]) for _ in range(200)]
    spark.createDataFrame(rows_of(*texts, None, texts[3]), SCHEMA).repartition(3).write.parquet(str(tmp_path / "d"))
    edges = p._edges
    monkeypatch.setattr(p, "_edges", lambda rows: most.append(max([x["count"] for x in rows.groupBy("h").count().collect()], default=0)) or edges(rows))
    want = brute.lpf_removal(list(enumerate([*texts, None, texts[3]])))
    for crowd in ({"crowd": 20}, {}):
        got = by_id(p.without_repeats(spark.read.parquet(str(tmp_path / "d")), **crowd))
        assert {d: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for d, x in got.items()} == want
    assert most[0] <= 20 < most[1]


def test_rules(docs, empty):
    from carelens.llm.op03_rules import judged
    got = by_id(judged(docs))
    for d, text, *_ in awkward():
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.rule_measures(text), d
        assert not (r.kept and r.base_failed)
    assert judged(empty).count() == 0


def test_rules_against_labels(spark):
    from carelens.llm.op03_rules import judged
    d = "/root/testdata/sf0.01"
    rows = judged(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    good = rows.where("quality = 1 and not base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    bad = rows.where("quality = 0").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good > 0.97 and bad < 0.1


def test_classifier(spark, docs, empty):
    from carelens.llm.op04_classifier import classify, held_out, op4_quality_classifier, reject_low
    d = "/root/testdata/sf0.01"
    rows = op4_quality_classifier(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out")
    assert rows.where("predicted = quality").count() > 0.95 * rows.count()
    labels = spark.createDataFrame([(5, 1), (9, 0), (9, 1), (None, 1), (3, None), (10_000, 0)], "doc_id long, quality int")
    assert docs.select(held_out()).distinct().count() == 2
    scores = [r.score for r in classify(docs, labels).collect()]
    assert len(scores) == len(awkward()) and all(0 <= s <= 1 for s in scores)
    assert {r.score for r in classify(docs, labels.where("false")).collect()} == {0.5}
    assert reject_low(docs, labels).columns == docs.columns and classify(empty, labels).count() == 0


def test_classifier_against_plain_loops(spark, docs, monkeypatch):
    """FTRL written out bucket by bucket over the same examples; scores as plain sums."""
    import math

    from carelens.llm import op04_classifier as op4

    seen, train = [], op4.train
    monkeypatch.setattr(op4, "train", lambda examples, *a: (seen.append(examples), train(examples, *a))[1])
    labels = docs.where("doc_id is not null").selectExpr("doc_id", "cast(doc_id % 2 as int) AS quality")
    weights, bias = op4.fit(docs, labels, bits=10)
    z, n = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= op4.L1:
            return 0.0
        return -(zi - math.copysign(op4.L1, zi)) / ((op4.BETA + math.sqrt(n.get(i, 0.0))) / op4.ALPHA + op4.L2)

    for _ in range(op4.EPOCHS):
        for bucket, value, y in seen[0]:
            x = [*zip(map(int, bucket), map(float, value)), (-1, 1.0)]
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, math.fsum(weight(i) * v for i, v in x)))))
            for (i, v), w in zip(x, [weight(i) for i, _ in x]):
                g = (p - y) * v
                grown = n.get(i, 0.0) + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(grown) - math.sqrt(n.get(i, 0.0))) / op4.ALPHA * w
                n[i] = grown
    assert bias == pytest.approx(weight(-1), abs=1e-9)
    assert np.allclose(weights, [weight(i) for i in range(1 << 10)], atol=1e-5)
    features = op4.Hasher(10)
    for r in docs.withColumn("s", op4.scorer(weights, bias, 10)(F.col("text"))).select("text", "s").collect():
        bucket, value = features(r.text)
        logit = bias + math.fsum(float(weights[i]) * v for i, v in zip(bucket, value))
        assert r.s == pytest.approx(1 / (1 + math.exp(-max(-35.0, min(35.0, logit)))), abs=1e-6)


def test_classifier_keeps_its_bound_whatever_repeats(spark, monkeypatch):
    from carelens.llm import op04_classifier as op4

    seen = []
    monkeypatch.setattr(op4, "train", lambda examples, bits: (seen.append(examples), (np.zeros(1 << bits, np.float32), 0.0))[1])
    many = spark.range(3000).selectExpr("1L AS doc_id", "concat('text ', id % 400) AS text").unionByName(
        spark.range(3, 9).selectExpr("id AS doc_id", "'same' AS text"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)] * 3, "doc_id long, quality int")
    op4.fit(many, labels, max_rows=5)
    assert len(seen[-1]) == 5
    op4.fit(many, labels, max_rows=1000)  # each text of doc 1 once, the others once unless held out
    learnt = many.where(~op4.held_out()).select("doc_id", "text").distinct().count()
    assert learnt > 400 and len(seen[-1]) == learnt


def test_lines_found_by_bisection(spark):
    from carelens.llm.op05_lines import dedup_lines, found_in

    r = random.Random(3)
    rows = []
    for size in [0, 1, 2, 3, 4, 7, 8, 9, 33]:
        array = sorted(r.sample(range(60), size))
        rows += [(array, k) for k in [-1, 61, *r.sample(range(60), 25), *array]]
    got = spark.createDataFrame(rows, "a array<int>, k int").select("a", "k", found_in(F.col("a"), F.col("k")).alias("f")).collect()
    assert all(x.f == (x.k in x.a) for x in got)
    lines = [f"line number {i} of a long list that many documents share" for i in range(20_000)]
    text = "\n".join(lines)
    five = spark.createDataFrame([(i, f"own {i}\n{text}") for i in range(5)], "doc_id long, text string")
    assert {x.doc_id: x.text for x in dedup_lines(five).collect()} == {**{i: f"own {i}" for i in range(4)}, 4: f"own 4\n{text}"}


def test_lines(docs, empty):
    from carelens.llm import op05_lines
    got = by_id(op05_lines._with_kept(docs, docs.columns, 40, 5).select(
        "doc_id", F.col("_llm_n").alias("n"), (F.col("_llm_n") - F.coalesce(F.size("_llm_kept"), F.col("_llm_n"))).alias("gone")))
    clean = by_id(op05_lines.dedup_lines(docs))
    for d, (n, gone, digest) in brute.line_dedup([r[:2] for r in awkward()]).items():
        r = got[d]
        assert (r.n, 0 if clean[d].text is None else brute.line_dedup([(d, awkward()[d][1])])[d][0] - r.n) == (n, 0)
        assert brute.sha(clean[d].text or "") == digest
    assert op05_lines.dedup_lines(empty).count() == 0 and list(clean[0].asDict()) == docs.columns
    twice = docs.union(docs)  # repeated rows count once as documents
    assert op05_lines.keys_to_drop(twice).count() == op05_lines.keys_to_drop(docs).count()


def test_token_counts(docs, empty):
    from carelens.llm import op06_tokens as t
    tokenizer = t.load(t.default_tokenizer())
    got = by_id(t.token_counts(docs, chunk=2000))
    for d, text, *_ in awkward():
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert (got[d].n_bytes, got[d].n_tokens, got[d].over_limit) == (len((text or "").encode()), n, n > 2048), d
    r = random.Random(2)
    bits = ["<|endoftext|>", "é", "́", "x" * 300, "  \n", "'s", "日本語", "　", "Σ", "\x85"]
    for _ in range(60):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 60)))
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert n == t.count_long(tokenizer, text, 40, 8) == t.WordCounts(tokenizer)([text])[0]
    assert t.token_counts(empty).count() == 0


def test_token_counts_of_a_tokenizer_that_keeps_blanks(docs):
    import public_tokenizers
    from carelens.llm import op06_tokens as p
    assert p.drops_blanks(p.load(p.default_tokenizer()))
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, got = p.load(path), by_id(p.token_counts(docs, path))
    assert not p.drops_blanks(tokenizer)
    for d, text, *_ in awkward():
        assert got[d].n_tokens == len(tokenizer.encode(text or "", add_special_tokens=False).ids), d


def test_nearest(spark):
    from carelens.llm.op07_ann import nearest
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 16)).astype(np.float32)
    x[100:400] = x[0]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(5000, None, 1), (5050, [0.0] * 16, 1), (5100, [float("nan")] * 16, 1), (None, [1.0] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {}
    for q in nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(q.query_id, []).append((q.vec_id, q.score))
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hit = 0
    for q in range(0, 3000, 50):
        c = u @ u[q]
        c[q] = -2
        edge = np.sort(c)[-5]
        hit += sum(s >= edge - 1e-9 for _, s in got[q])
        assert len(got[q]) == 5 and all(abs(c[v] - s) < 1e-9 for v, s in got[q])
    assert len(got) == 60 and hit >= 0.9 * 300
    assert [v for v, _ in got[0]] == [100, 101, 102, 103, 104]  # ties to the smaller id
    assert nearest(df.where("false")).count() == 0
    few = nearest(df.where("vec_id in (0, 1, 2)")).collect()
    assert len(few) == 2


def test_nearest_cuts_over_ids_not_rows(spark):
    from carelens.llm.op07_ann import nearest
    r = np.random.default_rng(1)
    x = r.normal(size=(30, 8))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x) for _ in range(2)]
    # id 100 stands close to query 0 with eight vectors, one of them five times
    rows += [(100, (x[0] + 0.01 * (j + 1) * x[1]).tolist(), 1) for j in [*range(8), 0, 0, 0, 0]]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).where("query_id = 0").orderBy("rank").collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = [i for i in np.argsort(-(u @ u[0]), kind="stable") if i][:4]
    assert [v.vec_id for v in got] == [100, *want]


def test_bagminhash_is_unbiased():
    from carelens.llm.op08_near import signatures
    r = np.random.default_rng(1)
    e = r.integers(0, 2**63, 300).astype(np.uint64)
    for _ in range(3):
        a, b = r.integers(0, 12, 300), r.integers(0, 12, 300)
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        s = signatures([(e[a > 0], a[a > 0]), (e[b > 0], b[b > 0])], 4096)
        assert abs((s[0] == s[1]).mean() - want) < 0.04


def test_near_duplicates(docs, empty, spark):
    from carelens.llm.op08_near import classes, components, keep_first
    want = brute.near_classes([r[:2] for r in awkward()])
    assert {d: r.class_id for d, r in by_id(classes(docs)).items()} == want
    kept = keep_first(docs.union(docs))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == docs.columns
    assert classes(empty).count() == 0 and keep_first(empty).count() == 0
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "x long, y long")
    assert {(r.v, r.c) for r in components(chain).collect()} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}


def test_personal_data(docs, empty, spark):
    from carelens.llm import op09_pii as p
    found = by_id(p.find(docs))
    for d, text, *_ in awkward():
        assert [(p.KINDS[x.k], x.s, x.e) for x in found[d].spans] == brute.personal(text), d
    secret = [f"note {i} {w} about Zebulon a@b.org closing {w}" for i, w in enumerate("abcdefgh")] + [f"plain filler text {i}" for i in range(300)]
    small = spark.createDataFrame(rows_of(*secret), SCHEMA)
    terms = by_id(p.spans_of(small))
    at = secret[0].index("Zebulon")
    assert (at, at + 7) in [(t.s, t.e) for t in terms[0].terms]
    clean = by_id(p.sanitise(small))
    assert "Zebulon" not in clean[0].text and "[email]" in clean[0].text and clean[20].text == secret[20]
    assert p.spans_of(empty).count() == 0


def test_copies_of_a_text_count_once_for_terms(spark):
    from carelens.llm import op09_pii as p
    near = [f"note {i} about Zebulon a@b.org" for i in range(3)]
    texts = near + ["Zebulon was seen elsewhere"] * 60 + [f"plain filler text {i}" for i in range(300)]
    rows = rows_of(*texts) + [(None, *rows_of("Zebulon was seen elsewhere")[0][1:])] * 5
    terms = by_id(p.spans_of(spark.createDataFrame(rows, SCHEMA).repartition(3)).where("doc_id < 3"))
    at = near[0].index("Zebulon")
    assert all((at, at + 7) in [(t.s, t.e) for t in terms[i].terms] for i in range(3))


def test_terms_are_paired_in_whole_documents_and_marked_everywhere(spark):
    from carelens.llm import op09_pii as p
    far = [f"Zebulon heads page {i} " + "and so on " * 30 + f"write to (a@b.org), Zebulon {'x' * i}" for i in range(4)]
    texts = far + ["no identifier but Zebulon, Zebulon Zebulonia"] + [f"plain filler text heads page and write {i}" for i in range(300)]
    small = spark.createDataFrame(rows_of(*texts), SCHEMA).repartition(3)
    terms = by_id(p.spans_of(small).where("size(terms) > 0"))
    assert set(terms) == set(range(5))
    for d in terms:
        want = [m.span() for m in brute.WORD.finditer(texts[d]) if m[0] == "Zebulon"]
        assert [(t.s, t.e) for t in terms[d].terms] == want, d
    clean = by_id(p.sanitise(small))
    assert clean[4].text == "no identifier but Zebulon,  Zebulonia"


def test_pieces(docs, empty):
    import sentencepiece
    from carelens.llm import op10_pieces as p
    library = sentencepiece.SentencePieceProcessor(model_file=p.default_model())
    got = by_id(p.encoded(docs))
    for d, text, *_ in awkward():
        assert got[d].ids == library.encode(text or "") and got[d].round_trip, d
    back = by_id(p.decoded(p.encoded(docs)))
    assert all(back[d].text == (text or "") for d, text, *_ in awkward())
    assert p.encoded(empty).count() == 0
    model = p.pieces(None, "unigram")
    assert model.decode(model.encode("a viterbi path")) == "a viterbi path"


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as c
    docs, sizes = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for k, (name, stage) in enumerate(c.STAGES):
        docs = stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
        if k < 4:
            assert docs.columns == columns
    assert 0 < sizes[2] <= sizes[1] == sizes[0] < 200
    before = [(r.doc_id, r.text) for r in spark.read.parquet(str(tmp_path / "lines")).collect()]
    after = {r.doc_id for r in spark.read.parquet(str(tmp_path / "near_copies")).collect()}
    assert after == set(brute.near_classes(before).values())
    assert docs.where("not round_trip").count() == 0
