"""Sharding, fingerprints, media, scores and the pipeline against plain versions."""

import hashlib
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwright.llm import fingerprint, lattice_lm, media, mixing, near_dedup, sharding, suffix_dedup, webp

MASK = (1 << 64) - 1


def hilbert(x, bits):
    """The index of a point by walking down the planes, as published by Skilling."""
    x, n, m = list(x), len(x), 1 << (bits - 1)
    q = m
    while q > 1:
        p = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= p
            else:
                t = (x[0] ^ x[i]) & p
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, m
    while q > 1:
        if x[-1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    return sum(((v >> b) & 1) << (n * b + n - 1 - i) for i, v in enumerate(x) for b in range(bits))


def test_shards_and_slots_equal_brute_force(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(i, "x" * int(rng.integers(0, 900)), ["en", "de", None][i % 3], f"s{rng.integers(0, 5)}", "clash", 3) for i in range(300)]
    rows += [(None, None, "en", None, "c", 1), (5, "y" * 30_000, "en", "s1", "c", 1), (5, "y" * 30_000, "en", "s1", "c", 1)]
    schema = "doc_id long, text string, lang string, source string, shard string, size int"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = [r.asDict() for r in sharding.op3_hilbert_sharding(spark, str(tmp_path)).collect()]
    assert len(got) == len(rows) and {r["law"] for r in got} == {"bytes"}
    size = lambda t: len((t or "").encode()) + 1
    cells = spark.createDataFrame(rows, schema).select(
        "doc_id", "text", sharding.quantised_name(F.col("lang")).alias("a"), sharding.quantised_name(F.col("source")).alias("b"),
        F.pmod(F.xxhash64("doc_id", F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0))), F.lit(256)).alias("mix"),
    ).collect()
    plain = []
    for r in cells:
        steps = min(255, math.floor(math.log2(size(r.text)) * 8))
        crc = zlib.crc32((r.text or "").encode())
        plain.append((hilbert((r.a, r.b, steps), 8), r.mix, r.doc_id if r.doc_id is not None else -1, crc, size(r.text)))
    plain.sort()
    total, before, slots, want = sum(p[-1] for p in plain), 0, Counter(), []
    for index, _, doc, crc, n in plain:
        shard = min(7, 8 * (2 * before + n) // (2 * total))
        want.append((index, doc, crc, n, shard, slots[shard]))
        slots[shard] += 1
        before += n
    assert sorted((r["hilbert"], -1 if r["doc_id"] is None else r["doc_id"], r["text_crc32"], r["size"], r["shard"], r["slot"]) for r in got) == sorted(want)


def mixed(x):
    return int(near_dedup.mix(np.array([x & MASK], dtype=np.uint64))[0])


def coin_labels(names):
    """Four rounds of coin tossing, one symbol at a time."""
    def toss(values):
        out = []
        for i, v in enumerate(values):
            before = values[i - 1] if i else v ^ 1
            k = ((v ^ before) & -(v ^ before)).bit_length() - 1
            out.append(2 * k + (v >> k & 1))
        return out

    for _ in range(4):
        names = toss(names)
    return names


def phrases(names):
    c = 0x9E3779B97F4A7C15
    runs = []
    for v in names:
        if runs and runs[-1][0] == v:
            runs[-1][1] += 1
        else:
            runs.append([v, 1])
    names = [mixed(v ^ (n * c & MASK)) if n > 1 else v for v, n in runs]
    labels, out = coin_labels(names), []
    for i, v in enumerate(names):
        left, right = labels[i - 1] if i else -1, labels[i + 1] if i + 1 < len(labels) else -1
        if i == 0 or (labels[i] > left and labels[i] > right and i > 1):
            out.append([])
        out[-1].append(v)
    return [mixed(sum(mixed((v + (k + 1) * c) & MASK) for k, v in enumerate(p)) & MASK) for p in out]


def plain_fingerprint(text):
    if not text:
        return bytes(2 * fingerprint.CELLS)
    names = [mixed((ord(ch) * 0x9E3779B97F4A7C15 + 1) & MASK) for ch in text]
    kept = []
    for level in range(1, fingerprint.LEVELS + 1):
        names = phrases(names)
        if level == 1:
            kept += [mixed((mixed((a + 0x9E3779B97F4A7C15) & MASK) + b) & MASK) for a, b in zip(names, names[1:])]
            continue
        kept += [mixed((v + level) & MASK) for v in names]
    cells = {}
    for v in sorted(kept, reverse=True):
        cells[(v >> 32) * fingerprint.CELLS >> 32] = v
    tries = near_dedup.probes(fingerprint.CELLS, 1024)
    full = [cells[i] if i in cells else cells[next(int(t[i]) for t in tries if int(t[i]) in cells)] for i in range(fingerprint.CELLS)]
    return np.array([mixed(v) & 0xFFFF for v in full], dtype=np.uint16).tobytes()


def test_likeness_of_edited_texts_does_not_fall_at_a_length():
    """Texts of 1 to 40 words and their edits: the longer, the more alike, with no step down on the way."""
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(400)]
    mean, other = [], []
    for n in (1, 4, 8, 12, 16, 20, 24, 30, 40):
        texts = [" ".join(rng.choice(words, n)) for _ in range(150)]
        edited = [t[: len(t) - len(t) // 4] + u[: len(t) // 4] for t, u in zip(texts, texts[1:] + texts[:1], strict=True)]
        a, b = fingerprint.fingerprints(texts), fingerprint.fingerprints(edited)
        mean.append(np.mean([fingerprint.likeness(x, y) for x, y in zip(a, b, strict=True)]))
        other.append(np.mean([fingerprint.likeness(x, y) for x, y in zip(a, a[1:] + a[:1], strict=True)]))
    assert all(later > earlier - 0.04 for earlier, later in zip(mean, mean[1:], strict=False)) and min(mean[2:]) > 0.38 and max(other) < 0.05, (mean, other)


def test_fingerprints_equal_plain_coin_tossing(spark):
    rng = np.random.default_rng(9)
    texts = ["", "a", "aaaa", "ab" * 40, "é汉 z" * 9] + ["".join(rng.choice(list("abcd efg\n"), rng.integers(2, 700))) for _ in range(25)]
    assert [x.hex() for x in fingerprint.fingerprints(texts)] == [plain_fingerprint(t).hex() for t in texts]
    rows = [(2 * i, t, "c", 1.0) for i, t in enumerate(texts)] + [(None, None, "c", 1.0), (4, "again", "c", 1.0)]
    got = fingerprint.compare_with_edit(spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, near_next double").repartition(3)).collect()
    order = sorted(((math.inf if i is None else i, t or "") for i, t, *_ in rows))
    want = []
    for k, (_, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        want.append((len(t), hashlib.sha256(edited.encode()).hexdigest(), plain_fingerprint(t).hex(), plain_fingerprint(edited).hex()))
    assert sorted((r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in got) == sorted(want)
    assert fingerprint.compare_with_edit(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_media_columns_equal_the_stored_files(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(None, None), (-1, "ab" * 40_000), (-1, "ab" * 40_000)], "doc_id long, text string"))
    stored = media.store(docs)
    files = sorted((r.doc_id or -2, hashlib.sha256(bytes(r.media)).hexdigest(), len(r.media)) for r in stored.collect())
    read = media.read_back(stored).collect()
    assert sorted((r.doc_id or -2, r.media_sha256, r.media_bytes) for r in read) == files
    for r in (x for x in read if x.doc_id in (-1, None)):
        data = np.frombuffer(media.payload(b"ab" * 40_000 if r.doc_id else b""), np.uint8).astype(int)
        edges = [i * len(data) // 64 for i in range(65)]
        bright = "".join("1" if data[a:b].sum() * len(data) > data.sum() * (b - a) else "0" for a, b in zip(edges[:-1], edges[1:], strict=True))
        assert r.feature == f"{int(bright, 2):016x}"
    assert media.read_back(media.store(docs.filter("false"))).count() == 0


def test_stored_files_use_what_the_format_has():
    rng = np.random.default_rng(0)
    ramp = lambda a, b: np.add.outer(a * np.arange(64), b * np.arange(64)).astype(np.uint8)
    smooth = np.stack([ramp(1, 2), ramp(3, 1), ramp(2, 5), np.full((64, 64), 255, np.uint8)], axis=-1)
    grey = rng.integers(0, 256, (64, 16), dtype=np.uint8)
    other = rng.integers(0, 256, (64, 16), dtype=np.uint8)
    followers = np.stack([grey, grey, grey, other], axis=-1)
    halves = np.stack([(grey.view(np.int8) >> 1).view(np.uint8), grey, (grey.view(np.int8) >> 1).view(np.uint8), other], axis=-1)
    texts = ("the same words come again and again, but never quite the same way; " * 40 + "x" * 64).encode()[:2048]
    cases = {"predictor": (smooth, 64, 64), "green": (followers, 16, 64), "cross": (halves, 16, 64), "palette": (b"abcdefgh" * 128, 16, 16), "copies": (texts, 16, 32)}
    words = " ".join(rng.choice(["the", "of", "and", "thing", "other"], 900)).encode()[:4096]
    cases["cache"] = (words, 16, 64)
    for part, (data, width, height) in cases.items():
        data, used = bytes(data) if isinstance(data, bytes) else data.tobytes(), {}
        file = webp.encode_samples(data, width, height, used)
        assert used[part], (part, used)
        assert webp.decode([file])[0].astype("<u4").tobytes() == data
    used = {}
    for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall():
        data = media.payload((r[0] or "").encode())
        webp.encode_samples(data, 16, len(data) // 64, used)
    assert min(used["copies"], used["cache"], used["palette"]) > 0


@pytest.mark.parametrize("seed", range(6))
def test_any_samples_come_back(seed):
    rng = np.random.default_rng(seed)
    files, want = [], []
    for _ in range(60):
        width, height = int(rng.integers(1, 40)), int(rng.integers(1, 40))
        colours = int(rng.choice([1, 2, 3, 5, 16, 17, 200, 256]))
        data = rng.integers(0, 256, colours, dtype=np.uint8)[rng.integers(0, colours, 4 * width * height)]
        if rng.random() < 0.5:
            data = np.tile(data[: max(4, len(data) // 5)], 6)[: 4 * width * height]
            data = np.append(data, np.zeros(4 * width * height - len(data), np.uint8))
        files.append(webp.encode_samples(data.tobytes(), width, height))
        want.append(data.tobytes())
    assert [p.astype("<u4").tobytes() for p in webp.decode(files)] == want


def test_lattice_side_by_side_equals_one_by_one():
    rng = np.random.default_rng(2)
    pieces = [bytes([b]) for b in range(97, 103)] + [b" "] + [bytes(rng.integers(97, 103, int(rng.integers(2, 6))).astype(np.uint8)) for _ in range(60)]
    pieces = list(dict.fromkeys(pieces)) + [b" ab", b" a"]
    weights = np.log(rng.dirichlet(np.ones(len(pieces))))
    lattice = lattice_lm.Lattice(pieces, weights.tolist())
    words = [bytes(rng.integers(97, 104, int(rng.integers(1, 90))).astype(np.uint8)) for _ in range(300)]
    one = np.array([lattice.score(w) for w in words])
    assert np.allclose(lattice.scores(words), one, rtol=1e-10) and np.isinf(one).any() and not np.isinf(one).all()
    known = [w for w, s in zip(words, one, strict=True) if np.isfinite(s)]
    times, both = rng.integers(1, 9, len(known)).astype(float), np.zeros((2, len(pieces)))
    lattice.expect_all(known, times, both[0])
    for w, t in zip(known, times, strict=True):
        once = np.zeros(len(pieces))
        lattice.expect(w, once)
        both[1] += t * once
    assert np.allclose(*both)


def test_scores_equal_the_lattices_of_the_words(spark, tmp_path):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = [(i, f"The cat {i % 3} sat\non THE w{i} unheardof{i}") for i in range(60)] + [(None, "cat"), (7, "z" * 200_000), (61, None)]
    clashing = [(i, t, True, 0.5, 1) for i, t in rows]
    spark.createDataFrame(clashing, "doc_id long, text string, held_out boolean, score double, n_known int").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = lattice_lm.op9_lattice_lm(spark, str(tmp_path)).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    words = [(t or "").encode().lower().split() for _, t in rows]
    train = Counter(w for (i, _), ws in zip(rows, words, strict=True) if not held(i) for w in ws)
    ends = sum(not held(i) for i, _ in rows)
    n = sum(train.values()) + ends
    pieces, prior = lattice_lm.vocabulary(path)
    weights = np.log(prior)
    for _ in range(lattice_lm.PASSES):
        lattice, uses = lattice_lm.Lattice(pieces, weights.tolist()), np.zeros(len(pieces))
        lattice.expect_all(list(train), np.array(list(train.values()), float), uses)
        posterior = uses + lattice_lm.PRIOR * np.array(prior)
        weights = np.log(posterior / posterior.sum())
    lattice, stop = lattice_lm.Lattice(pieces, weights.tolist()), (ends + 0.5) / (n + 1)
    novel = min(0.5, (sum(c == 1 for c in train.values()) + 1) / (n - ends + 2))
    want = []
    for (i, _), ws in zip(rows, words, strict=True):
        each = [lattice.score(w) for w in ws]
        edge = [np.logaddexp(s + math.log(novel), math.log((1 - novel) * train[w] / (n - ends)) if train[w] else -math.inf) for s, w in zip(each, ws, strict=True)]
        total = lambda x: (sum(x) + len(ws) * math.log(1 - stop) + math.log(stop)) / math.log(10)  # noqa: B023, E731
        want.append((-1 if i is None else i, held(i), len(ws) + 1, round(total(each), 3), round(total(edge), 3)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, round(r.score, 3), round(r.word_edge_score, 3)) for r in got) == sorted(want)


def test_a_common_line_is_few_rows_of_a_task_and_none_is_lost(spark):
    rng = np.random.default_rng(11)
    line, passage = "this line of sixty bytes stands in very many documents, here ", "".join(rng.choice(list("abcdefgh "), 260))
    word = lambda: "".join(rng.choice(list("klmnopq"), rng.integers(20, 90)))
    rows = [(i, f"{word()} {line}{word()} {passage[i % 9: 240 + i % 11] if i % 2 else word()} {word()}") for i in range(160)] + [(None, passage), (None, passage), (3, line * 4)]
    seen, want = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        raw, gone = t.encode(), set()
        for a in range(len(raw) - 99):
            if raw[a : a + 100] in seen:
                gone.update(range(a, a + 100))
            seen.add(raw[a : a + 100])
        want.append((-1 if i is None else i, len(raw), len(gone)))
    for parts in (1, 6):
        got = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), 100).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed) for r in got) == sorted(want)
    name, around, doc = np.repeat(np.array([7, 8]), 500), np.append(np.zeros(500, int), np.arange(500)), np.arange(1000)
    made = suffix_dedup.combined([name, around, doc, np.zeros(1000, int), np.zeros(1000, int)])
    at_name = (made[5] == suffix_dedup.TO_DECIDE) | (made[5] == suffix_dedup.TELLING)
    assert Counter(made[0][at_name].tolist()) == {7: 1, 8: 2}


def test_pipeline_stages_equal_brute_force(spark, tmp_path):
    import corpus_pipeline as P
    from loomwright.llm.common import materialize

    rng = np.random.default_rng(3)
    words = lambda n: " ".join(f"t{int(x)}" for x in rng.integers(0, 5000, n))
    texts = [words(60) for _ in range(40)]
    for i in range(8):
        texts[2 * i + 20] = f"{texts[2 * i + 20]} scumlord idiotic filth"
    texts[5], texts[6], texts[8] = texts[4], texts[4] + " extra", texts[8] + " " + texts[9][:180]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)] + [(50, None, None, None, None), (51, "", "en", "s0", 0)]
    at = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    marks = [(i, 1, int("scumlord" in t)) for i, t in enumerate(texts)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    docs, kept = spark.read.parquet(f"{at}/documents.parquet"), []
    for name, stage in P.STAGES:
        docs, path = materialize(stage(spark, docs, at), name)
        kept.append((docs, path))
    text = {i: t for i, t, *_ in rows}
    ids = lambda k: sorted(r.doc_id for r in kept[k][0].select("doc_id").collect())
    clean = [i for i, t in text.items() if "scumlord" not in (t or "")]
    assert ids(0) == clean
    shingles = {i: set(near_dedup.shingles(text[i], 5).tolist()) for i in clean}
    label = {i: i for i in clean}
    for _ in clean:
        for i in clean:
            for j in clean:
                if shingles[i] and 5 * len(shingles[i] & shingles[j]) >= 4 * len(shingles[i] | shingles[j]):
                    label[i] = label[j] = min(label[i], label[j])
    alone = [i for i in clean if label[i] == i]
    assert ids(1) == alone and 5 not in alone and 6 not in alone
    seen, left = set(), {}
    for i in alone:
        raw = (text[i] or "").encode()
        gone = set()
        for a in range(len(raw) - 99):
            if raw[a : a + 100] in seen:
                gone.update(range(a, a + 100))
            seen.add(raw[a : a + 100])
        left[i] = bytes(b for k, b in enumerate(raw) if k not in gone).decode()
    assert {r.doc_id: r.text or "" for r in kept[2][0].collect()} == left
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{kept[2][1].removeprefix('file://')}/*.parquet')")
    taken = {r[0]: (r[1], r[2]) for r in con.sql(f"SELECT doc_id, size, taken FROM ({mixing.OP4_SQL})").fetchall()}
    copies = Counter(r.doc_id for r in kept[3][0].collect())
    assert {i: c for i, c in copies.items()} == {i: round(t / s) for i, (s, t) in taken.items() if s and t}
    pieces = kept[4][0].collect()
    assert Counter(r.doc_id for r in pieces if r.piece == 0) == copies
    by_sequence: dict = {}
    for r in pieces:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False)) and parts[0][0] == 0 and sum(parts[-1]) <= 2048
