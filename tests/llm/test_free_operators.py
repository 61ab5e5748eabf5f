"""Embeddings, packing, toxicity, SimHash, quality and the token store against brute force, round trips and held-out accuracy."""

import io
import zlib
from functools import cache

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waferlens.llm import itq, packing, quality, simhash, tokenstore, toxicity
from waferlens.llm.common import connected_components
from waferlens.llm.tokens import PieceEncoder, default_vocabulary


def _components(ids, links):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


# --- connected components
@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    r = np.random.default_rng(seed)
    links = [tuple(map(int, p)) for p in r.integers(0, 60, (45, 2))] + [(200 + i, 201 + i) for i in range(40)] + [(300, 300 + i) for i in range(50)]
    got = {q.node: q.component for q in connected_components(spark.createDataFrame([*links, (None, 1), (5, 5)], "u long, v long")).collect()}
    want = _components({x for p in links for x in p}, links)
    assert got == {k: v for k, v in want.items() if any(k in p and p[0] != p[1] for p in links)}


def test_frequent_keys_are_dealt_over_slices(spark):
    from waferlens.llm.common import join_hot

    large = spark.createDataFrame([(k, i) for k, n in ((1, 90), (2, 11), (3, 1), (None, 2)) for i in range(n)], "k long, i long")
    small = large.groupBy("k").agg(F.count("*").alias("rows")).withColumn("name", F.concat(F.lit("n"), F.col("k").cast("string")))
    for how in ("inner", "left"):
        plain, dealt = (join_hot(large, small, "k", "rows", ["i"], how, key_rows=n) for n in (1000, 10))
        assert dealt.columns == plain.columns and dealt.exceptAll(plain).count() == plain.exceptAll(dealt).count() == 0
        assert "_slice" in dealt._jdf.queryExecution().toString() and "_slice" not in plain._jdf.queryExecution().toString()


def test_scratch_is_shared_and_cleared(spark):
    from pathlib import Path

    from waferlens.llm.common import clear_scratch, cut, scratch_path

    kept = cut(spark.range(3), "probe")
    assert kept.count() == 3 and spark.conf.get("spark.checkpoint.dir") in kept.inputFiles()[0]
    clear_scratch(spark)
    assert not Path(scratch_path(spark, "x")).parent.exists()


# --- tokens and packing
TEXTS = [None, "", " ", "  a  b ", "\n x", "a \n b\tc   d", "it's 'tis ' s we'll", "　 x y", "naïve café ÀÉ 12 3½ Ⅷ", "日本語 テキスト", "<|endoftext|> x", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "  <|endoftext|>\n x <|endoftext", "it's<|endoftext|>'s", "a\x1cb \x1c c", "Ünïcodé \U0001f600!!"]


def test_pieces_encode_as_the_library_does(docs):
    encoder, plain = PieceEncoder(max_pieces=50), _opened()
    texts = [*TEXTS, *[r.text for r in docs.select("text").collect()]]
    for at in range(0, len(texts), 20):
        part = texts[at : at + 20]
        for t, ids in zip(part, encoder.encode(part), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(t or "", add_special_tokens=False).ids, t


@cache
def _opened():
    return Tokenizer.from_file(default_vocabulary())


def _ids(text, end):
    return [*_opened().encode(text or "", add_special_tokens=False).ids, end]


def test_packing_is_gapless_and_tight(docs, hard_docs):
    for df in (docs, hard_docs):
        rows = packing.pack_documents(df).collect()
        texts = [(r.doc_id, r.text) for r in df.collect()]
        want = []
        for k, t in texts:
            ids, a = _ids(t, 0), 0
            b, piece = len(ids) % 2048 or 2048, 0
            while a < len(ids):
                want.append((k, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
                a, b, piece = b, b + 2048, piece + 1
        assert sorted(map(str, [tuple(r)[:5] for r in rows])) == sorted(map(str, want))
        bins = {}
        for r in rows:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for own in bins.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= 2048
        total = sum(w[3] for w in want)
        assert len(bins) <= -(-total // 2048) * 1.01 + 1
    assert packing.pack_documents(hard_docs.limit(0)).count() == 0


def test_local_search_raises_squared_fill_and_empties_bins():
    capacity = 100
    lengths = [60, 40, 55, 45, 50, 50]
    bins = [[0], [1, 2], [3], [4], [5]]
    out = packing.local_search([list(b) for b in bins], lengths, capacity)
    assert len(out) == 3 and sorted(i for b in out for i in b) == list(range(6))
    r = np.random.default_rng(1)
    for _ in range(20):
        lengths = r.integers(1, 60, 40).tolist()
        start = [[i] for i in range(40)]
        out = packing.local_search([list(b) for b in start], lengths, 64)
        fills = [sum(lengths[i] for i in b) for b in out]
        assert max(fills) <= 64 and sum(f * f for f in fills) >= sum(x * x for x in lengths) and len(out) < 40
        assert sorted(i for b in out for i in b) == list(range(40))


def test_best_fit_takes_the_tightest_bin():
    assert sorted(map(sorted, packing.best_fit_decreasing([6, 5, 4, 5], 10))) == [[0, 2], [1, 3]]
    assert packing.pack_lengths([], 10) == []


# --- token store
def test_store_round_trip_equals_encoding(docs, hard_docs):
    for df in (docs, hard_docs):
        rows = df.select("doc_id", F.coalesce("text", F.lit(""))).collect()
        got = tokenstore.store_round_trip(df).collect()
        want = sorted((-1 if k is None else k, len(_ids(t, 2)), zlib.crc32(np.array(_ids(t, 2), "<u4").tobytes())) for k, t in rows)
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
        at, last = 0, -1
        for r in sorted(got, key=lambda r: r.start):
            key = -1 if r.doc_id is None else r.doc_id
            assert r.start == at and key >= last
            at, last = at + r.n_tokens, key
    assert tokenstore.store_round_trip(hard_docs.limit(0)).count() == 0


class _Counted(io.BytesIO):
    fetched = 0

    def size(self):
        return len(self.getbuffer())

    def read(self, n=-1):
        self.fetched += n
        return super().read(n)


def test_readers_fetch_only_what_is_asked_for_and_check_it():
    r = np.random.default_rng(0)
    docs = [(i, r.integers(0, 50_000, 40_000).astype("<u4").tobytes()) for i in range(30)]
    sink = io.BytesIO()
    assert tokenstore.write_file(sink, docs) == (30, 30 * 40_000)
    raw = sink.getvalue()
    source = _Counted(raw)
    tokens = tokenstore.TokenFile(source)
    assert len(tokens.frames) > 5
    opened = source.fetched
    assert next(tokens.read([17])).astype("<u4").tobytes() == docs[17][1]
    assert source.fetched - opened < len(raw) / 5
    broken = bytearray(raw)
    broken[200_000] ^= 1
    with pytest.raises(Exception):
        list(tokenstore.TokenFile(_Counted(bytes(broken))).read(range(30)))
    import zstandard

    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True) as whole:  # an ordinary reader skips the index
        assert len(whole.read()) == 30 * 40_000 * 2


def test_ids_beyond_16_bits_are_kept_or_refused():
    wide = [(1, np.array([5, 70_000, 2], "<u4").tobytes())]
    with pytest.raises(ValueError):
        tokenstore.write_file(io.BytesIO(), wide)
    sink = io.BytesIO()
    tokenstore.write_file(sink, wide, width=4)
    assert next(tokenstore.TokenFile(_Counted(sink.getvalue())).read([0])).tolist() == [5, 70_000, 2]


def test_files_follow_the_bytes_and_paths_are_qualified(spark, docs, tmp_path):
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    manifest = tokenstore.write_tokens(docs, str(tmp_path / "t"), file_bytes=size // 5)
    assert 3 <= manifest.count() <= 20 and tokenstore.qualified(spark, "/x/y") == "file:///x/y"
    assert tokenstore.read_tokens(spark, str(tmp_path / "t"), manifest).count() == docs.count()


# --- SimHash
def _plain_fingerprint(text, k=4):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not w:
        return 0
    sh = [" ".join(w)] if len(w) < k else [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_equals_brute_force(spark, docs, hard_docs):
    near = spark.createDataFrame([(9_000 + i, "lorem ipsum dolor sit amet " * 40 + f"end{i % 3}") for i in range(9)], "doc_id long, text string")
    df = docs.select("doc_id", "text").unionByName(near)
    texts = {r.doc_id: r.text for r in df.collect()}
    fps = {k: _plain_fingerprint(t) for k, t in texts.items()}
    ids = sorted(fps)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 4]
    want = _components(ids, links)
    got = simhash.near_duplicates(df).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {k: (f"{fps[k]:016x}", want[k]) for k in ids}
    hard = simhash.near_duplicates(hard_docs).collect()
    assert len(hard) == hard_docs.count()
    assert {r.fingerprint for r in hard if r.doc_id in (2, 3, 4)} == {"0" * 16}
    assert {r.component_id for r in hard if r.doc_id in (6, 7)} == {6}
    assert simhash.near_duplicates(hard_docs.limit(0)).count() == 0


def test_block_links_connect_what_all_links_connect():
    r = np.random.default_rng(2)
    base = r.integers(0, 2**64, 60, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base[:30]:
        x = int(b)
        for _ in range(6):
            x ^= 1 << int(r.integers(64))
            fps.add(x)
    fps = simhash._order(np.array(sorted(fps), np.uint64))
    plain = [(int(a), int(b)) for i, a in enumerate(fps) for b in fps[i + 1 :] if (int(a) ^ int(b)).bit_count() <= 4]
    ids = [int(f) for f in fps]

    def pairs(a, b, places):
        return [(int(a[i]), int(b[j])) for i, j in places]

    assert _components(ids, pairs(fps, fps, simhash.block_links(fps[:, None], None, 4, tile=16))) == _components(ids, plain)
    left, right = fps[::2], fps[1::2]
    cross = pairs(left, right, simhash.block_links(left[:, None], right[:, None], 4, tile=16))
    both = [*pairs(left, left, simhash.block_links(left[:, None], None, 4)), *pairs(right, right, simhash.block_links(right[:, None], None, 4)), *cross]
    assert _components(ids, both) == _components(ids, plain)


# --- embeddings
def _vectors(seed=0):
    r = np.random.default_rng(seed)
    rows, k = [], 0
    for label in (0, 1, None):
        for _ in range(40):
            c = r.normal(size=32)
            for _ in range(int(r.integers(1, 6))):
                rows.append((k, [float(x) for x in c + r.normal(size=32) * r.choice([0.02, 0.2])], label))
                k += 1
    v = rows[0][1]
    return [*rows, (k, v, 0), (k + 1, v, 1), (k + 1, v, 1), (k + 2, [0.0] * 32, 0), (k + 3, None, 0), (k + 4, [None] * 32, 0), (k + 5, [float("nan")] * 32, 1), (k + 6, [float("inf")] * 32, 1), (k + 7, [1.0, 2.0], 0), (k + 8, [2.0, 4.0], 0), (k + 9, [], 0)]


def test_embedding_links_equal_brute_force(spark):
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit(1)).withColumn("n", F.lit(2))
    good = [(k, np.array(v), label) for k, v, label in rows if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n, links = [0] * len(good), []
    for i, (a, v, la) in enumerate(good):
        for j, (b, w, lb) in enumerate(good[:i]):
            if la == lb and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93:
                n[i] += 1
                n[j] += 1
                links.append((a, b))
    comp = _components({k for k, *_ in rows}, links)
    want = sorted([(k, c, comp[k], comp[k] == k) for (k, *_), c in zip(good, n, strict=True)] + [(r[0], 0, comp[r[0]], comp[r[0]] == r[0]) for r in rows if not any(r[0] == g[0] and r[2] == g[2] for g in good)])
    # One table alone, and as many as wide keys need; buckets cut into slices or not.
    for options in ({}, {"bucket_rows": 8}, {"bucket_rows": 8, "slice_rows": 8}):
        got = sorted(map(tuple, itq.near_duplicates(df, **options).collect()))
        found, whole = sum(g[1] for g in got), sum(w[1] for w in want)
        assert found >= 0.99 * whole and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
        assert [g[0] for g in got] == [w[0] for w in want]
    assert itq.near_duplicates(df.limit(0)).count() == 0


def _pairs_near_the_threshold(dims, n, seed):
    """Unit vectors, each with a neighbour at a cosine between 0.93 and 0.94, around an offset that the rotation must cope with."""
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dims)) + 0.3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = r.normal(size=(n, dims))
    y -= (y * x).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    c = r.uniform(0.9301, 0.94, (n, 1))
    return np.concatenate([x, c * x + np.sqrt(1 - c * c) * y])


@pytest.mark.parametrize("dims", [16, 32, 64, 128, 384])
def test_recall_near_the_threshold_at_registered_parameters(spark, dims):
    """Wide keys, as a label of some hundred thousand rows has them: buckets are made small here instead."""
    rows = _pairs_near_the_threshold(dims, 600, dims)
    cos = rows @ rows.T
    want = int(np.triu(cos >= 0.93, 1).sum())
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    for options in ({}, {"bucket_rows": 10}):
        found = sum(r.n_links for r in itq.near_duplicates(df, **options).collect()) / 2
        assert found <= want and found >= 0.985 * want, (found, want)


def test_tables_follow_rows_and_flips():
    for flips in (0.1, 0.12, 0.16):
        for n in (10, 3_000, 10**5, 10**7, 10**9):
            width, tables, reach = itq.tables_for(n, flips)
            assert width * tables <= 64 and 2**width <= max(1, n)
            assert itq.missed(width, tables, reach, flips) <= itq.MISSED or width == 0
    assert itq.tables_for(2_000, 0.12) == (0, 1, 0)


def test_each_length_has_its_rotation():
    x = np.random.default_rng(0).normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    mean, w, flips = itq.learn_rotation(x)
    assert np.allclose(w.T @ w, np.eye(64), atol=1e-8) and 0.08 < flips < 0.16
    bits = np.unpackbits(itq.codes_of(x, (mean, w, flips)).view(np.uint8).reshape(-1, 8), axis=1)
    assert np.abs(bits.mean(0) - 0.5).max() < 0.1
    mean, w, _ = itq.learn_rotation(x[:, :24])
    assert w.shape == (24, 64)
    rare = itq.random_rotation(7)
    assert rare[1].shape == (7, 64) and (rare[1] == itq.random_rotation(7)[1]).all()


# --- quality
def test_machine_equals_all_pairs():
    r = np.random.default_rng(0)
    m = quality.FactorisationMachine(0.3, r.normal(size=quality.WIDTH).astype(np.float32), r.normal(size=(quality.WIDTH, 3)).astype(np.float32))
    ids, x = np.array([3, 17, 99]), np.array([0.5, 1.0, -2.0], np.float32)
    pairs = sum(m.factors[ids[a]] @ m.factors[ids[b]] * x[a] * x[b] for a in range(3) for b in range(a))
    assert m.logits(ids, x, np.array([0]))[0] == pytest.approx(0.3 + m.linear[ids] @ x + pairs, rel=1e-5)


def _held_out(rows, truth):
    own = [r for r in rows if r.held_out and r.doc_id in truth]
    return np.array([r.predicted for r in own]), np.array([truth[r.doc_id] for r in own])


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = quality.classify(spark.read.parquet(f"{d}/documents.parquet"), labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    p, y = _held_out(rows, {r.doc_id: r.quality for r in labels.collect()})
    assert (p == y).mean() > 0.93 and p[y == 1].mean() > 0.97


def test_quality_on_hard_rows(hard_docs, no_docs, labels, spark):
    assert quality.classify(hard_docs, labels).count() == hard_docs.count()
    assert quality.classify(no_docs, labels).count() == 0
    none = quality.classify(hard_docs, labels.limit(0)).collect()
    assert len(none) == hard_docs.count() and len({r.score for r in none}) == 1
    clash = spark.createDataFrame([(1, 0), (1, 1), (5, 1), (8, 0), (None, 1), (10, None)], "doc_id long, quality int")
    assert quality.classify(hard_docs, clash).count() == hard_docs.count()


# --- toxicity
def test_gradients_are_right():
    net = toxicity.fit(["good word here", "bad word there", "good", "bad", "bad word", "good word"], [0, 1, 0, 1, 1, 0], epochs=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(0)
    ids = r.integers(0, len(net.p["words"]), (toxicity.WINDOW, 3))
    chars, y, w = r.normal(size=(toxicity.WINDOW, 3, toxicity.DIM)) * 0.3, np.array([0.0, 1.0, 1.0]), np.full(3, 1 / 3)

    def loss():
        x = np.concatenate([net.p["words"][ids], chars], 2).astype(np.float32)
        f = toxicity._direction(x @ net.p["w_f"] + net.p["b_f"], net.p["u_f"])
        b = toxicity._direction((x @ net.p["w_b"] + net.p["b_b"])[::-1], net.p["u_b"])[::-1]
        z = toxicity._pool(net.p, np.concatenate([f, b], 2), ids != toxicity.PAD)[0]
        return float((np.logaddexp(0, z) - y * z) @ w)

    g, _ = toxicity._gradients(net, ids, chars, y, w)
    for name in ("u_f", "u_b", "w_f", "w_b", "b_f", "att_w", "att_v", "out", "out_b"):
        at = tuple(int(r.integers(n)) for n in net.p[name].shape)
        old, eps = net.p[name][at], 1e-2
        net.p[name][at] = old + eps
        up = loss()
        net.p[name][at] = old - eps
        down = loss()
        net.p[name][at] = old
        assert g[name][at] == pytest.approx((up - down) / 2 / eps, abs=2e-3, rel=0.05), name


def test_windows_cover_every_word():
    for n in (0, 1, 48, 49, 84, 85, 1000):
        starts = toxicity.window_starts(n)
        covered = {i for s in starts for i in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n)) and all(b - a <= toxicity.STRIDE for a, b in zip(starts, starts[1:], strict=False))


def _small_network():
    texts = ["good morning to all of you", "you utter scum go away", "what a good day", "scum and filth", "go away now", "a fine day to all"] * 2
    return toxicity.fit(texts, [0, 1, 0, 1, 0, 0] * 2, epochs=4)


def test_words_are_read_to_their_end():
    a, b = "x" * 72 + "a", "x" * 72 + "b"
    assert "".join(toxicity.words_of(a)) == a and len(toxicity.words_of("日本語" * 40)) == 5
    scorer = toxicity.Scorer(_small_network())
    assert scorer.texts([a])[0] != scorer.texts([b])[0]


def test_scorer_equals_a_plain_forward_pass(docs):
    net = _small_network()
    texts = [None, "", "one", "scum " * 200, *[r.text for r in docs.limit(30).collect()]]

    def direction(x, d):
        p, h, out = net.p, np.zeros(toxicity.HIDDEN), []
        n = toxicity.HIDDEN
        for v in x:
            i, r = v @ p[f"w_{d}"] + p[f"b_{d}"], h @ p[f"u_{d}"]
            z, reset = 1 / (1 + np.exp(-(i[:n] + r[:n]))), 1 / (1 + np.exp(-(i[n : 2 * n] + r[n : 2 * n])))
            h = (1 - z) * np.tanh(i[2 * n :] + reset * r[2 * n :]) + z * h
            out.append(h)
        return np.array(out)

    def window(words):
        vectors = []
        for w in words:
            raw = b"\x02" + w.encode() + b"\x03"
            grams = [(raw[i] * 961 + raw[i + 1] * 217 + raw[i + 2] * 13) % toxicity.GRAMS for i in range(len(raw) - 2)]
            vectors.append([*net.p["words"][net.vocabulary.get(w, toxicity.OTHER)], *net.p["grams"][grams].mean(0)])
        x = np.zeros((toxicity.WINDOW, 2 * toxicity.DIM))
        x[:, : toxicity.DIM] = net.p["words"][toxicity.PAD]
        x[: len(words)] = np.array(vectors).reshape(-1, 2 * toxicity.DIM)
        states = np.concatenate([direction(x, "f"), direction(x[::-1], "b")[::-1]], 1)
        e = np.tanh(states @ net.p["att_w"]) @ net.p["att_v"]
        real = np.arange(toxicity.WINDOW) < len(words)
        e = np.exp(np.where(real | ~real.any(), e, -1e9) - e.max())
        return float(e / e.sum() @ states @ net.p["out"] + net.p["out_b"][0])

    want = []
    for t in texts:
        words = toxicity.words_of(t)
        want.append(max(window(words[s : s + toxicity.WINDOW]) for s in toxicity.window_starts(len(words))))
    assert toxicity.Scorer(net).texts(texts) == pytest.approx(np.array(want), abs=1e-4)


def test_every_window_of_a_long_text_can_become_the_trained_one():
    """Windows of low word odds, far from the start, in a text of hundreds of windows: whichever the network suspects is sent."""
    vocabulary, odds = toxicity.word_odds({"scum": (1, 40), "day": (50, 10), "hint": (20, 30)}, 50, 50)

    class Suspicious:
        def documents(self, docs):
            own = [[d[s : s + toxicity.WINDOW].count("day") for s in toxicity.window_starts(len(d))] for d in docs]
            return np.concatenate(own), np.cumsum([0, *map(len, own)])[:-1]

    scorer = Suspicious()
    for place in (0, 900, 5_000, 19_900):
        words = ["scum" if k % 7 else "hint" for k in range(20_000)]
        words[place : place + 30] = ["day"] * 30
        (by_odds,), (by_network,) = toxicity.look([words], [1], vocabulary, odds), toxicity.look([words], [1], vocabulary, odds, scorer)
        assert "day" not in by_odds[0] or place == 0
        assert by_network[0].count("day") >= 12 and len(by_network) == 1 + toxicity.DRAWN
    drawn = {tuple(w) for seed in range(40) for w in toxicity.look([[str(k) for k in range(120)]], [seed], {}, np.zeros(2, np.float32))[0][1:]}
    assert len(drawn) == len(toxicity.window_starts(120))


def test_training_in_tasks_equals_training_here(spark, docs, labels):
    """Texts of any length, the same windows and so the same network, whether tasks look or the driver."""
    net = toxicity.train(docs, labels, epochs=4)
    sample = toxicity.labelled_sample(docs, labels, "toxic", 4, 2, 6000).orderBy("_id").collect()
    texts, known = [toxicity.words_of(r.text) for r in sample], {}

    def looked(held, epoch, rows):
        seeds = [zlib.crc32(f"{epoch}:{sample[i]['_id']}".encode()) for i in rows]
        return dict(zip(rows, toxicity.look([texts[i] for i in rows], seeds, net.vocabulary, known["odds"], toxicity.Scorer(held) if held else None), strict=True))

    counts = {w: [0, 0] for w in net.vocabulary}
    for words, r in zip(texts, sample, strict=True):
        for w in set(words) & set(counts):
            counts[w][r.label] += 1
    toxic = sum(r.label for r in sample)
    vocabulary, known["odds"] = toxicity.word_odds(counts, toxic, len(sample) - toxic, 2 * len(counts))
    assert vocabulary == net.vocabulary
    here = toxicity.fit_windows(looked, [r.label for r in sample], vocabulary, known["odds"], epochs=4)
    assert all(np.allclose(here.p[k], net.p[k], atol=1e-4) for k in net.p)


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = toxicity.classify(spark.read.parquet(f"{d}/documents.parquet"), labels).collect()
    p, y = _held_out(rows, {r.doc_id: r.toxic for r in labels.collect()})
    assert p[y == 1].mean() > 0.85 and p[y == 0].mean() < 0.04
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_toxicity_on_hard_rows(hard_docs, no_docs, labels):
    rows = toxicity.classify(hard_docs, labels).collect()
    assert len(rows) == hard_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.classify(no_docs, labels).count() == 0
    assert toxicity.classify(hard_docs, labels.limit(0)).count() == hard_docs.count()
