"""Toxicity, lattice scores, WebP and the pipeline."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from loomwright.llm import lattice_lm, media, toxicity, webp


@pytest.mark.parametrize("seed", range(25))
def test_webp_round_trip_of_every_part(seed):
    rng = np.random.default_rng(seed)
    h, w, colours = int(rng.integers(1, 30)), int(rng.integers(1, 30)), int(rng.choice([1, 2, 3, 10, 200, 9999]))
    pixels = rng.integers(0, 2**32, colours)[rng.integers(0, colours, (h, w))]
    bits, wide, parts = int(rng.integers(2, 5)), w, {}
    if colours <= 200 and seed % 2:
        parts["palette"], wide = True, -(-w >> webp._palette_bits(len(np.unique(pixels))))
    tiles = -(-h >> bits), -(-wide >> bits)
    if seed % 3:
        parts["predictor"] = rng.integers(0, 14, tiles)
    if seed % 4 > 1:
        parts["cross"] = rng.integers(0, 2**24, tiles)
    if seed % 5 > 2:
        parts["groups"] = rng.integers(0, 3, tiles)
    file = webp.encode(pixels, tile_bits=bits, green=bool(seed % 2), cache_bits=int(rng.choice([0, 1, 6, 11])), references=seed % 3 == 0, **parts)
    other = webp.encode_samples(bytes(range(256)), 16, 4)
    a, b, c = webp.decode([file, other, file])
    assert (a == pixels).all() and (c == pixels).all() and b.astype("<u4").tobytes() == bytes(range(256))


def test_bad_files_raise():
    good = webp.encode_samples(b"abcd" * 64, 16, 4)
    for bad in (b"", b"RIFF", good[:20], b"RIFX" + good[4:], good[:20] + b"\0" + good[21:]):
        with pytest.raises(ValueError):
            webp.decode([bad])


def test_payloads_come_back(spark):
    texts = [None, "", "a", "é" * 70, "x" * 64, "the same", "the same", "long " * 9000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in media.read_back(media.store(df)).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        data = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (got[i].n_bytes, got[i].payload_bytes) == (len(raw), len(data))
        assert got[i].payload_sha256 == hashlib.sha256(data).hexdigest() and got[i].tail_crc32 == zlib.crc32(data[-64:])
    assert got[5][3:] == got[6][3:]


def test_tall_payloads_fit():
    data = np.random.default_rng(0).integers(0, 256, 64 * 16_390, dtype=np.uint8).tobytes()
    (samples, shape), = media.samples_of([media.to_file(data)], [len(data)])
    assert samples.tobytes() == data and shape == (8195, 32)


def test_lattice_equals_sum_over_segmentations():
    rng = np.random.default_rng(0)
    pieces = [b" ", b" a", b" ab", b"b", b"ba", b"a", b"bab", b"c"]
    weights = rng.dirichlet(np.ones(len(pieces)))
    lattice, of = lattice_lm.Lattice(pieces, np.log(weights).tolist()), dict(zip(pieces, weights, strict=True))

    def every(text):
        return 1.0 if not text else sum(of[text[:k]] * every(text[k:]) for k in range(1, len(text) + 1) if text[:k] in of)

    for word in (b"a", b"ab", b"abab", b"babacab", b"ccc"):
        assert math.isclose(lattice.score(word), math.log(every(b" " + word)), rel_tol=1e-12)
        uses = [0.0] * len(pieces)
        lattice.expect(word, uses)
        assert math.isclose(sum(u * len(p) for u, p in zip(uses, pieces, strict=True)), len(word) + 1, rel_tol=1e-9)
    assert lattice.score(b"zz") == -math.inf


def test_base_scores_equal_brute_force(spark):
    import public_tokenizers

    rows = [(i, f"The cat {i % 3} sat\non THE w{i}", i % 4 == 1) for i in range(40)] + [(90, None, False), (91, "", True), (92, "x" * 3000, True), (0, "The cat", False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    got = lattice_lm.score_documents(df, public_tokenizers.path("piece_bpe_32k.model")).collect()
    tokens = [(t or "").encode().lower().split() + [None] for _, t, _ in rows]
    train = Counter(x for ts, (_, _, h) in zip(tokens, rows, strict=True) if not h for x in ts)
    n, v = sum(train.values()), len(train)
    want = [
        (i, len(ts), sum(train[x] > 0 for x in ts), n, round(sum(math.log10((train[x] + 0.5) / (n + 0.5 * (v + 1))) for x in ts), 6))
        for (i, _, _), ts in zip(rows, tokens, strict=True)
    ]
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    assert all(-1e9 < r.score < 0 for r in got)
    assert lattice_lm.score_documents(df.filter("false"), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_gradients_of_the_network():
    rng, net = np.random.default_rng(0), toxicity.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    counted, cells = rng.standard_normal((5, 7, 3)), rng.integers(0, 50, (5, 7))
    mask, target = np.arange(7) < np.array([7, 3, 0, 5, 1])[:, None], np.array([1, 0, 1, 0, 1.0])

    def loss():
        rows = np.concatenate([counted, net.p["embed"][cells]], axis=-1)
        both = np.concatenate([rows @ net.p[f"w{x}"] + net.p[f"b{x}"] for x in "fb"], axis=-1).transpose(1, 0, 2)
        z = net.logits(both, mask)
        return np.mean(np.logaddexp(0, z) - target * z)

    found = net.gradients(counted, cells, mask, target, np.ones(5))
    for k, v in net.p.items():
        at = (int(cells[0, 0]), 1) if k == "embed" else tuple(int(rng.integers(0, s)) for s in v.shape)
        old, step = v[at], 1e-2
        v[at] = old + step
        above = loss()
        v[at] = old - step
        below = loss()
        v[at] = old
        assert abs((above - below) / 2 / step - found[k][at]) < 1e-3


def test_held_out_toxicity():
    rng = np.random.default_rng(1)
    plain, bad = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}a" for i in range(200)], ["idiotish", "idiotle", "scumlor"]
    texts, labels = [], []
    for i in range(500):
        ws, y = list(rng.choice(plain, rng.integers(5, 260))), int(i % 5 == 0)
        for _ in range(3 * y):
            ws.insert(int(rng.integers(0, len(ws))), bad[rng.integers(3)])
        texts.append(" ".join(ws))
        labels.append(y)
    model = toxicity.fit(texts[:400], labels[:400])
    scores = model.scores([*texts[400:], None, "", "12 %%"])
    assert ((scores[:100] >= 0.5) == np.array(labels[400:])).mean() > 0.95
    assert ((scores >= 0) & (scores <= 1)).all() and scores[100] == scores[101] == scores[102] < 0.5
    few = toxicity.fit(["bad idea", "good day", None, "fine words"], [1, 0, 0, 0]).scores(["bad", "good", None])
    assert np.isfinite(few).all()
    one = toxicity.fit(["a", "b"], [0, 0])
    assert one.scores(["x"]).tolist() == [0.25]


def test_windows_overlap_and_reach_the_end():
    for n in (0, 1, 64, 65, 112, 113, 1000):
        starts = toxicity.window_starts(n)
        assert starts[-1] + toxicity.WINDOW >= n and all(b - a <= toxicity.STRIDE for a, b in zip(starts, starts[1:], strict=False))


def test_pipeline_on_small_tables(spark, tmp_path):
    import corpus_pipeline
    from loomwright.llm.common import materialize

    words = np.random.default_rng(3)
    texts = [" ".join(f"t{int(x)}" for x in words.integers(0, 5000, 60)) for _ in range(30)]
    texts[5], texts[6] = texts[4], texts[4] + " extra"
    texts[8] = texts[8] + " " + texts[9][:180]
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(texts)] + [(50, None, None, None, None), (51, "", "en", "s0", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs, _ = materialize(stage(spark, docs, str(tmp_path)), name)
        kept.append(docs)
    ids = lambda d: sorted((r.doc_id for r in d.select("doc_id").collect()), key=lambda x: (x is None, x))
    assert ids(kept[0]) == [*range(30), 50, 51]
    assert ids(kept[1]) == [i for i in [*range(30), 50, 51] if i not in (5, 6)]
    after = {r.doc_id: r.text for r in kept[2].collect()}
    assert after[9].startswith(texts[9][180:].strip()[:5]) or len(after[9]) < len(texts[9])
    assert after[8] == texts[8] and all(after[i] == texts[i] for i in range(30) if i not in (5, 6, 9))
    assert kept[3].columns == list(corpus_pipeline.COLUMNS)
    assert kept[4].count() >= kept[3].count()


def test_webp_files_stay_as_they_were(monkeypatch):
    rng = np.random.default_rng(12)
    words = [bytes(rng.integers(97, 123, int(rng.integers(2, 9))).astype(np.uint8)) for _ in range(300)]
    texts = [b" ".join(words[int(i)] for i in rng.integers(0, 300, n)) for n in (0, 1, 9, 40, 200, 900)]
    texts += [b"ab" * 500, bytes(range(256)) * 9, bytes(rng.integers(0, 256, 3000).astype(np.uint8)), bytes(64) + b"x" * 5000]
    packed, most = webp._packed, []
    monkeypatch.setattr(webp, "_packed", lambda w, values, sizes: most.append(len(values)) or packed(w, values, sizes))
    files = [media.to_file(media.payload(t)) for t in texts]
    assert hashlib.sha256(b"".join(files)).hexdigest() == "5820899af12243942d60ebb7c79dc2809c238df461a72748162a0658022d2c31"
    # One number a pixel at most is put into the stream, not one for each channel.
    assert all(n <= len(media.payload(t)) // 4 for n, t in zip(most, texts, strict=True))
    read = media.samples_of(files, [len(media.payload(t)) for t in texts])
    assert [x.tobytes() for x, _ in read] == [media.payload(t) for t in texts]
