"""Packing, conversation repair and Merkle manifests against plain Python, on awkward small tables."""

import hashlib
import heapq
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tests.llm.test_llm import SCHEMA, awkward, rows_of

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, tree string, idx int, rank long, copy long, length int, n int"


def stored(spark, tmp_path, rows, schema, name):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def clashing(rows):
    return [(*r[:5], "x", 1, 2, 3, 4, 5) for r in rows]


# --- packing -------------------------------------------------------------------------------------

def test_ids_equal_the_library(monkeypatch):
    from tokenizers import Tokenizer

    from carelens.llm import op11_packing as p
    path = p.default_tokenizer()
    library, encode, r = Tokenizer.from_file(path), p.encoder(path), random.Random(1)
    letters = list("ab é'.,!?\n\t  09_-") + ["<|endoftext|>", "日", "\x1c", "\x85", "́", "　"]
    texts = ["", " ", "it's  fine.\tno?\r\n\n  yes ,a", "  <|endoftext|>\n\n", "word." * 50 + "\n" * 20]
    texts += ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(500)]
    for size in (1 << 20, 20):  # whole, and in slices
        monkeypatch.setattr(p.slices, "__defaults__", (size,))
        assert all(encode(t).tolist() == library.encode(t, add_special_tokens=False).ids for t in texts)


def test_packing_keeps_every_id_in_few_sequences(spark, tmp_path):
    from tokenizers import Tokenizer

    from carelens.llm import op11_packing as p
    rows = clashing(awkward()) + clashing(rows_of(None, "", "same text", "same text", first=3)) + [(None, "no id", *clashing(awkward())[0][2:])] * 3
    got = p.op11_best_fit_packing(spark, stored(spark, tmp_path, rows, EXTRA, "documents")).collect()
    library = Tokenizer.from_file(p.default_tokenizer())
    want, total = Counter(), 0
    for doc_id, text, *_ in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        total += len(ids)
        want.update((doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got) == want
    by = defaultdict(list)
    for x in got:
        by[x.sequence_id].append((x.offset, x.length))
    for parts in by.values():
        ends = [0] + [a + n for a, n in sorted(parts)]
        assert [a for a, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048
    assert len(by) <= -(-total // 2048) + 1
    assert p.packed(spark.createDataFrame([], EXTRA)).count() == 0


def test_plan_uses_every_piece_and_near_the_least_sequences(monkeypatch):
    from carelens.llm import op11_packing as p
    r = random.Random(4)
    for high, many in ((2048, 10**6), (300, 5000), (2048, 3), (1100, 40_000)):
        counts = np.zeros(2049, np.int64)
        for _ in range(600):
            counts[r.randint(1, high)] += r.randint(1, many)
        slots, sequences = p.plan(counts)
        ranks, room = defaultdict(list), defaultdict(int)
        for length, a, b, each, first, offset in slots.tolist():
            ranks[length].append((a, b))
            if many < 100:
                for k in range((b - a) // each):
                    room[first + k] += length * each
        for length, spans in ranks.items():
            spans.sort()
            assert spans[0][0] == 0 and spans[-1][1] == counts[length] and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
        assert sum(b - a for _, a, b, *_ in slots.tolist()) == counts.sum() and all(v <= 2048 for v in room.values())
        least = max(-(-int((counts * np.arange(2049)).sum()) // 2048), int(counts[1025:].sum()))
        # best fit alone, longest first, is near the least there is
        monkeypatch.setattr(p, "patterns", lambda *_: np.empty((0, 3), np.int64))
        alone = p.plan(counts)[1]
        monkeypatch.undo()
        assert least <= sequences <= 1.005 * alone + 2


def test_patterns_fit_by_least_squares():
    from carelens.llm import op11_packing as p
    kinds = np.array([[2, 1, 1], [3, 1, 0], [4, 0, 0]])
    x = p.fit(kinds, np.array([0, 11, 4, 3, 5]), 2000)  # least squares: 4.4, 2.0 ... each length weighs alike
    used = np.bincount(kinds.ravel(), (x[:, None] * (kinds > 0)).ravel(), 5)
    base = ((used - [0, 11, 4, 3, 5])[1:] ** 2).sum()
    for k in range(3):
        for step in (-.05, .05):
            y = x.copy()
            y[k] = max(0, y[k] + step)
            other = np.bincount(kinds.ravel(), (y[:, None] * (kinds > 0)).ravel(), 5)
            assert ((other - [0, 11, 4, 3, 5])[1:] ** 2).sum() >= base - 1e-6


# --- conversations -------------------------------------------------------------------------------

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if how == 1 else "".join(c for c in text if c not in ".!?") if how == 2 else text
        for _ in range({0: 0, 3: 2}.get(how, 1)):
            yield conv, turn, "user" if how == 4 else role, text


def cheapest(rows):
    """Shortest path by (cost, audit) over (rows done, last initial)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, q, out = heapq.heappop(heap)
        if i == len(rows) and q in ("", "a"):
            return cost, audit, out
        if (i, q) in done:
            continue
        done.add((i, q))
        ways = [(2, "I", i, NEXT[q], ((NAMES[NEXT[q]], ""),))]
        if i < len(rows):
            role, text, fault = rows[i]
            ways.append((3, "D", i + 1, q, ()))
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                ways.append((2 + late, "R", i + 1, NEXT[q], ((NAMES[NEXT[q]], text),)))
                if role[:1] == NEXT[q] or (role[:1] == "s" and q == ""):
                    ways.append((late, "K", i + 1, role[:1], ((role, text),)))
        for c, edit, j, to, made in ways:
            heapq.heappush(heap, (cost + c, audit + edit, j, to, out + made))


def brute_repair(rows, hash_of):
    convs = {r[0]: [] for r in rows}
    for r in damaged(rows):
        convs[r[0]].append(r[1:])
    for conv, some in convs.items():
        some.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hash_of(r[2])))
        seen, judged = set(), []
        for _, role, text in some:
            core = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
            seen.add((role, text))
            judged.append((role, text, fault))
        turns, n = [t for t, *_ in some if t is not None], Counter(f for *_, f in judged)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, out = cheapest(judged)
        yield (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
               hashlib.sha256("\n".join(f"{a}:{b}" for a, b in out).encode()).hexdigest())


def test_repair_equals_shortest_paths_at_any_chunk_size(spark, tmp_path, monkeypatch):
    from carelens.llm import op12_repair as p
    r = random.Random(2)
    texts = ["Yes.", "no", "", " ", "Hello there!", "ok?", "a.b", None, "x.\n", "y" * 5000 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    rows = [(c, None if r.random() < .05 else t * r.choice([1, 1, 2]), r.choice(roles), r.choice(texts) if r.random() < .6 else f"t{t}{r.choice('.!? ')}")
            for c in [None, *range(60)] for t in range(r.choice([0, 1, 2, 5, 30]))]
    rows += [rows[5]] * 40 + [(7, 3, "user", "same.")] * 60 + [(999, t, r.choice(roles[:2]), f"w{t}.") for t in range(300)]
    path = stored(spark, tmp_path, [(*x, 1, "z", 2) for x in rows], "conv_id long, turn long, role string, text string, n int, audit string, k long", "conversations")
    plain = spark.createDataFrame([(t,) for t in {y for x in rows for y in (x[3] or " ", (x[3] or " ").translate({ord(c): None for c in ".!?"}))} | {""}], "text string")
    known = {x.text: (x.h1, x.h2) for x in plain.select("text", *p._hashes()).collect()}
    want = sorted(brute_repair(rows, known.__getitem__), key=str)
    for size in (256, 3):
        monkeypatch.setattr(p.repairs, "__defaults__", (size,))
        assert sorted(map(tuple, p.op12_conversation_repair(spark, path).collect()), key=str) == want
    made = p.repaired(p.damage(spark.read.parquet(f"{path}/conversations.parquet"))).where("conv_id = 999").orderBy("place")
    lines = "\n".join(f"{x.role}:{x.text}" for x in made.collect())
    assert hashlib.sha256(lines.encode()).hexdigest() == next(w[-1] for w in want if w[0] == 999)


def test_repair_of_an_empty_table(spark, tmp_path):
    from carelens.llm import op12_repair as p
    path = stored(spark, tmp_path, [], "conv_id long, turn long, role string, text string", "conversations")
    assert p.op12_conversation_repair(spark, path).count() == 0


# --- manifests -----------------------------------------------------------------------------------

def digest(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def leaf(r, text):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, i):
    for level in tree[:-1]:
        yield level[i // 3 * 3:i], level[i + 1:i // 3 * 3 + 3]
        i //= 3


def brute_manifest(rows):
    of = defaultdict(list)
    for r in rows:
        of[r[3]].append(r)
    order = sorted(of, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        of[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[s] = levels([leaf(r, r[1]) for r in of[s]])
    top = levels([trees[s][-1][0] for s in order])
    for k, s in enumerate(order):
        for i, r in enumerate(of[s]):
            way = [*siblings(trees[s], i), *siblings(top, k)]
            text = r[1].replace("\n", "") if r[1] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[1]
            at = leaf(r, text)
            for a, b in way:
                at = digest(*a, at, *b)
            yield leaf(r, r[1]), r[0], trees[s][-1][0], top[-1][0], digest(*(x for a, b in way for x in a + b)), at, at == top[-1][0]


def test_manifest_equals_plain_trees(spark, tmp_path):
    from carelens.llm import op13_merkle as p
    many = [(i, f"t{i}\n\n", "en", "big", 3) for i in range(300)] + [(None, None, None, None, None)] * 2 + [(5, "again", "en", "big", 1)] * 9
    rows = clashing(awkward()) + clashing(many) + clashing(rows_of("alone", source=lambda i: "one leaf"))
    got = p.op13_merkle_manifest(spark, stored(spark, tmp_path, rows, EXTRA, "documents"))
    cols = ["leaf", "doc_id", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(tuple(x) for x in got.select(*cols).collect()) == Counter(brute_manifest(rows))


def test_manifest_of_one_source_one_row_and_none(spark, tmp_path):
    from carelens.llm import op13_merkle as p
    for k, rows in enumerate(([(1, "a\nb", "en", "s", 3)], [(i, "x", "en", "s", 1) for i in range(81)], [(i, "x", None, f"s{i}", 1) for i in range(100)])):
        folder = tmp_path / str(k)
        folder.mkdir()
        got = p.op13_merkle_manifest(spark, stored(spark, folder, clashing(rows), EXTRA, "documents"))
        cols = ["leaf", "doc_id", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        assert Counter(tuple(x) for x in got.select(*cols).collect()) == Counter(brute_manifest(rows))
    (tmp_path / "none").mkdir()
    assert p.op13_merkle_manifest(spark, stored(spark, tmp_path / "none", [], EXTRA, "documents")).count() == 0


# --- suffix dedup: rows keep their names however a scan is split ------------------------------------

def test_suffix_dedup_when_the_scan_is_split_anew(spark, tmp_path):
    from carelens.llm.op02_lpf import without_repeats
    from tests.llm import brute
    rows = awkward()
    spark.createDataFrame(rows, SCHEMA).repartition(6).write.parquet(str(tmp_path / "d"))
    keys = {"spark.sql.files.openCostInBytes": ("1", "64m"), "spark.sql.files.minPartitionNum": ("16", "1"), "spark.sql.files.maxPartitionBytes": ("4k", "128m")}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, (first, _) in keys.items():
            spark.conf.set(k, first)
        found = without_repeats(spark.read.parquet(str(tmp_path / "d")))
        for k, (_, then) in keys.items():
            spark.conf.set(k, then)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == brute.lpf_removal([r[:2] for r in rows])
    made = spark.createDataFrame(rows, SCHEMA).withColumn("f", F.lit(1)).withColumn("row", F.lit(2))  # no files, clashing names
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in without_repeats(made).collect()} == got


# --- mixing: columns by any name --------------------------------------------------------------------

def test_mixing_keeps_columns_named_like_its_own(spark, tmp_path):
    from carelens.llm.op01_mixing import mix_documents
    names = ["weight", "quota", "cap", "total", "_from", "_end", "_n", "_all", "_rest", "_first", "_s", "_h", "_t", "_w"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in names)
    docs = spark.createDataFrame([(*r[:5], *range(100 * k, 100 * k + len(names))) for k, r in enumerate(awkward())], schema)
    made, plain = mix_documents(docs), mix_documents(docs.select(*docs.columns[:5]))
    assert made.columns == docs.columns
    extra = {r.doc_id: tuple(r[n] for n in names) for r in docs.collect()}
    rows = made.collect()
    assert all(tuple(r[n] for n in names) == extra[r.doc_id] for r in rows)
    assert Counter(tuple(r[:5]) for r in rows) == Counter(tuple(r) for r in plain.collect())
