"""Training-data operators against brute force, round trips and held-out accuracy, with the odd inputs each must take.

``ODD`` holds null and empty texts, a null and a repeated doc_id, repeated rows, a long text and ties; a
table with further columns (some with the operators' own names) and an empty table are derived from it.
"""

import io
import itertools
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from actionlens.llm import (common, components, decontamination, jaccard_join, license_scan, line_crf, packing, quality_knn, queries,
                            sharding, textops, token_frames, tokens, toxicity, url_filter)
from actionlens.llm.common import shared_folder
from tests.conftest import SF_SMALL

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PROSE = "The quick brown fox jumps over the lazy dog while five wizards mix quiet potions in the old stone tower tonight. "
ODD = [(1, PROSE), (2, None), (3, ""), (4, PROSE), (4, PROSE), (5, PROSE * 800), (None, "No number here, only some words that fill a line."), (6, " \n\t "), (7, "a"),
       (8, "  two   spaces \n\n and\nlines "), (9, "Élan, ça va ? 你好 世界 don't stop"), (9, "other text under the same number")]
LABELS = [(1, 1, 0), (3, 0, 0), (4, 1, 0), (5, 0, 1), (None, 1, 1), (7, None, None), (9, 0, 0)]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    return docs.select("*", F.lit("en").alias("lang"), F.lit("x").alias("row"), F.lit(1).alias("k1"), F.lit("y").alias("score"), F.lit(None).cast("string").alias("label"), F.lit(0).alias("_at"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def _key(r):
    return tuple((v is not None, v) for v in r)


def _tokenizer():
    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    return t


def _ids(text):
    return _tokenizer().encode(text or "", add_special_tokens=False).ids + [2]


# ---- text helpers --------------------------------------------------------------------------------------------


def test_piecewise_encoding_is_the_tokenizers():
    texts = ["", None, " ", "  a", "a  b", "a   b ", "x\n \ny", "x\n  y", "x\n\ny z", "\n", "don't I'll a's b'", "ab. cd, ef.. g ü. ». x.", "\u3000x \u00a0 y", "a\x1c \x1cb",
             "é «x» à la", "<|endoftext|> a<|endoftext|>", "x" * 300 + " y", "1 2 33 4a", "नमस्ते दुनिया", "😀 😀😀", "tab\t x", PROSE * 3]
    got = []
    for a, b, flat, per in tokens.encoder(TOKENIZER).encode(pa.array(texts)):
        at = np.r_[0, np.cumsum(per)]
        got += [flat[at[i]:at[i + 1]].tolist() for i in range(b - a)]
    assert got == [_ids(t)[:-1] for t in texts]


def test_added_tokens_in_texts_get_the_librarys_ids(spark):
    plain = Tokenizer.from_file(TOKENIZER)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "one<|endoftext|><|endoftext|> two.", "x <|endof", "text|> y", "<|endoftext|", "no such string, here.", None, "é <|endoftext|>\n z", PROSE]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 220, 50256, 275]
    got = []
    for a, b, flat, per in tokens.encoder(TOKENIZER, encode_special_tokens=False).encode(pa.array(texts)):
        at = np.r_[0, np.cumsum(per)]
        got += [flat[at[i]:at[i + 1]].tolist() for i in range(b - a)]
    assert got == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = shared_folder(spark, "test-frames")
    token_frames.write(docs, folder, TOKENIZER)
    wanted = {i: (len(x) + 1, zlib.crc32(np.array(x + [2], "<u4").tobytes())) for i, x in enumerate(want)}
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in token_frames.read(spark, folder).collect()} == wanted
    assert {r.doc_id: r.ids for r in packing.pack_documents(docs, TOKENIZER, 1024, 2, with_ids=True).collect()} == {i: x + [2] for i, x in enumerate(want)}


def test_words_and_hashes():
    texts = ["a b", "", None, " b\ta\x0bc\r\n", "x" * 100, "x" * 100 + " b"]
    seen = {}
    for a, _, buf, off in textops.slices(pa.array(texts), 4):
        start, end, row = textops.words(buf, off)
        for h, s, e, r in zip(textops.span_hash(buf, start, end), start, end, row):
            seen.setdefault(a + r, []).append((buf[s:e].tobytes().decode(), int(h)))
    assert {k: [w for w, _ in v] for k, v in seen.items()} == {i: WORD.findall(t) for i, t in enumerate(texts) if t and WORD.findall(t)}
    assert len({h for v in seen.values() for _, h in v}) == len({w for v in seen.values() for w, _ in v})


# ---- 1 token files -------------------------------------------------------------------------------------------


def test_token_frames_round_trip(spark, odd, tmp_path):
    folder = shared_folder(spark, "test-frames")
    token_frames.write(odd, folder, TOKENIZER)
    got = sorted(token_frames.read(spark, folder).collect(), key=lambda r: r.start)
    want = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [d for d, _ in want]
    assert [r.start for r in got] == [0, *itertools.accumulate(r.n_tokens for r in got)][:-1]
    crc = lambda t: zlib.crc32(np.array(_ids(t), "<u4").tobytes())
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted((d or 0, len(_ids(t)), crc(t)) for d, t in ODD)
    assert {r.doc_id: r.ids for r in token_frames.lookup(spark, folder, spark.createDataFrame([(5,), (99,)], "doc_id long")).collect()} == {5: _ids(PROSE * 800)}
    empty = shared_folder(spark, "test-frames")
    token_frames.write(odd.limit(0), empty, TOKENIZER)
    assert token_frames.read(spark, empty).count() == 0


def test_frames_are_independent_and_checked(monkeypatch):
    monkeypatch.setattr(token_frames, "FRAME_IDS", 10)
    f = io.BytesIO()
    w = token_frames.FrameWriter(f, 2)
    docs = [np.arange(25, dtype=np.uint32), np.zeros(0, np.uint32), np.array([7], np.uint32)]
    for i, d in enumerate(docs):
        w.add(i if i else None, d)
    w.close()
    r = token_frames.FrameReader(f)
    assert [r.ids(k).tolist() for k in (2, 0, 1)] == [docs[2].tolist(), docs[0].tolist(), []] and r.is_null.tolist() == [True, False, False]
    data = f.getvalue()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()       # any reader takes the file
    assert np.frombuffer(plain, "<u2").tolist() == [*range(25), 7]
    broken = bytearray(data)
    broken[12] ^= 255
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_frames.FrameReader(io.BytesIO(bytes(broken))).ids(0)


# ---- 2 Jaccard join ------------------------------------------------------------------------------------------


def _sets(texts, k):
    out = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOW))
        out.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    return out


def _components(sets, percent):
    up = list(range(len(sets)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = find(i), find(j)
            up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def _links(sets, percent):
    out = [0] * len(sets)
    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            out[i], out[j] = out[i] + 1, out[j] + 1
    return out


def _near_copies(n, seed):
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(300)]
    base = [[vocab[i] for i in rng.integers(0, 300, rng.integers(3, 80))] for _ in range(6)]
    out = []
    for _ in range(n):
        w = list(base[rng.integers(6)])
        for i in range(len(w)):
            if rng.random() < rng.choice([0.0, 0.01, 0.03, 0.1]):
                w[i] = vocab[rng.integers(300)].upper()
        out.append(" ".join(w) + rng.choice(["", " "]))
    return out


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_jaccard_join_is_exact(spark, k, percent):
    texts = _near_copies(300, k) + [t for _, t in ODD]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = _sets(texts, k)
    want = [(i, len(sets[i]), c, m) for i, (c, m) in enumerate(zip(_components(sets, percent), _links(sets, percent)))]
    assert max(m for *_, m in want) > 3
    assert sorted(tuple(r) for r in jaccard_join.near_duplicates(docs, k, percent).collect()) == want


def test_jaccard_join_odd_rows(spark, odd):
    got = Counter(tuple(r) for r in jaccard_join.near_duplicates(odd, 3, 90).collect())
    n = {d: len(s) for (d, _), s in zip(ODD, _sets([t for _, t in ODD], 3))}
    assert got[(4, n[4], 1, 3)] == 2 and got[(1, n[1], 1, 3)] == 1 and got[(5, n[5], 1, 3)] == 1 and got[(2, 0, 2, 0)] == 1 and got[(7, 1, 7, 0)] == 1
    assert got[(None, n[None], None, 0)] == 1 and sum(got.values()) == len(ODD)
    assert jaccard_join.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [80, 90])
def test_recursive_join_and_regions_lose_no_link(percent, monkeypatch):
    """Deep recursion, and regions split into Voronoi cells, agree with all pairs."""
    monkeypatch.setattr(jaccard_join, "LEAF", 4)
    monkeypatch.setattr(jaccard_join, "RUN", 16)
    rng = np.random.default_rng(percent)
    base = [rng.integers(0, 2**63, rng.choice([50, 100, 500, 540, 1020, 1100]), dtype=np.uint64) for _ in range(12)]
    sets = []
    for _ in range(150):
        s = base[rng.integers(12)].copy()
        at = rng.choice(len(s), rng.binomial(len(s), rng.choice([0.02, 0.06])), replace=False)
        s[at] = rng.integers(0, 2**63, len(at), dtype=np.uint64)
        sets.append(np.unique(s))
    want = _components([set(s.tolist()) for s in sets], percent)
    found = jaccard_join.MetricJoin(sets, percent).join()
    assert [int(found.find(i)) for i in range(len(sets))] == want
    assert found.linked_copies(np.ones(len(sets), int), np.zeros(len(sets), int)).tolist() == _links([set(s.tolist()) for s in sets], percent)
    n = np.array([len(s) for s in sets])
    bits = 6 + jaccard_join.level(n)
    vec = [np.bincount((textops.mix(s) >> np.uint64(64 - b)).astype(int), minlength=1 << b).astype(np.uint8).tobytes() for s, b in zip(sets, bits.tolist())]
    forest = jaccard_join.Forest()
    jaccard_join._join_region(n, vec, list(range(len(sets))), percent, forest)
    assert all(forest.find(i) == forest.find(w) for i, w in enumerate(want))


@pytest.mark.parametrize("bound,value", [("BLOCK", 20), ("SHINGLES", 500)])
def test_blocks_of_a_large_cluster(spark, monkeypatch, bound, value):
    monkeypatch.setattr(jaccard_join, bound, value)
    texts = _near_copies(120, 9)
    texts += texts[:10]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = jaccard_join.near_duplicates(docs, 3, 80).orderBy("doc_id").collect()
    sets = _sets(texts, 3)
    assert [(r.component_id, r.n_links) for r in got] == list(zip(_components(sets, 80), _links(sets, 80)))


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150)] + [(300, j) for j in range(301, 340)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[100], got[150], got[200]} == {100} and {got[j] for j in range(300, 340)} == {300}


def test_jaccard_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = sorted(con.execute(f"SELECT doc_id, n_shingles, component_id, n_links FROM ({queries.OP2_SQL})").fetchall())
    assert sorted(tuple(r) for r in queries.op2_jaccard_join(spark, SF_SMALL).collect()) == want


# ---- 3 toxicity, 10 quality ----------------------------------------------------------------------------------


def _corpus(spark, n=600, seed=3):
    """Prose, of which some rows carry two insults of a made-up language with varying ends, and some are symbol noise."""
    rng = np.random.default_rng(seed)
    syllable = ["an", "ti", "ore", "the", "ing", "ou", "re", "sha", "lo", "men"]
    word = lambda: "".join(rng.choice(syllable, rng.integers(1, 5)))
    insult = lambda: rng.choice(["zgrumpf", "kwizzel"]) + "".join(rng.choice(syllable, rng.integers(0, 2)))
    docs, labels = [], []
    for i in range(n):
        w = [word() for _ in range(rng.integers(15, 120))]
        toxic, bad = i % 5 == 0, i % 7 == 0
        if toxic:
            for _ in range(2):
                w.insert(rng.integers(len(w)), insult())
        docs.append((i, " ".join(x + rng.choice(["###", "$$$", "%%%"]) for x in w) if bad else ". ".join(" ".join(w[j:j + 9]).capitalize() for j in range(0, len(w), 9))))
        labels.append((i, int(not bad), int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out(spark):
    docs, labels = _corpus(spark)
    got = toxicity.judged(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert sum(r.predicted == r.toxic for r in held) >= 0.95 * len(held)


def test_string_kernel_tolerates_gaps():
    model = toxicity.fit([["foo", "bar", "zgrumpf", "lorem"], ["ipsum", "zgrumpf", "dolor"], ["zgrumpf", "amet"]] * 5 + [["foo", "bar", "lorem", "ipsum", "dolor", "amet", "grape", "trump"]] * 15,
                         np.array([1] * 15 + [0] * 15))
    score = lambda *texts: np.concatenate([s for _, _, s in toxicity.score_texts(pa.array(texts), model)])
    plain, gapped, inserted, spaced, clean = score("foo zgrumpf bar", "foo z.g-r.u.m.p.f bar", "foo zgruxmpf bar", "foo z g r u m p f bar", "foo lorem bar")
    assert plain == pytest.approx(gapped) and plain == pytest.approx(spaced, abs=0.2) and min(plain, gapped, inserted) > clean


def test_explicit_features_are_the_kernel():
    """The feature map's product is the gap-weighted count of common triples."""
    def kernel(a, b):
        sub = lambda w: Counter()
        out = []
        for w in (a, b):
            c = Counter()
            for i, j, k in itertools.combinations(range(len(w)), 3):
                if k - i < toxicity.SPAN:
                    c[w[i] + w[j] + w[k]] += toxicity.DECAY ** (k - i + 1)
            out.append(c)
        x, y = out
        return sum(x[t] * y[t] for t in x) / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    for a, b in (("banana", "bandana"), ("idiot", "idxiot"), ("abcabc", "cabcab")):
        w, f, v = toxicity.features([a, b])
        x = [dict(zip(f[w == i].tolist(), v[w == i])) for i in (0, 1)]
        assert sum(x[0][t] * x[1].get(t, 0) for t in x[0]) == pytest.approx(kernel(a, b))


def test_margins_are_exact_above_the_floor():
    rng = np.random.default_rng(5)
    beta = np.zeros(toxicity.ALPHABET ** 3, np.float32)
    some = ["banana", "aaaaaaaaaa", "abcabcabc", "mississippi", "idiot", "zzzxxxzzz", *("".join(rng.choice(list("abcde"), rng.integers(3, 12))) for _ in range(400))]
    w, f, v = toxicity.features(some)
    blob = [x.encode() for x in some]
    end = np.cumsum([len(b) for b in blob])
    for bias in (-1.0, -0.5, 0.3):
        beta[f] = rng.normal(0, 1, len(f))
        true = np.bincount(w, v * beta[f], len(some)) + bias
        got = toxicity.margins(np.frombuffer(b"".join(blob), np.uint8), np.r_[0, end[:-1]], end, beta, bias)
        above = true > toxicity.FLOOR
        assert above.any() and (~above).any()
        assert got[above] == pytest.approx(true[above], abs=1e-5) and (got[~above] <= toxicity.FLOOR + 1e-5).all()


def test_stems_shared_by_toxic_documents_are_telling():
    """No word repeats; the insults of the second kind share no letters with those of the first."""
    rng = np.random.default_rng(2)
    tail = lambda: "".join(rng.choice(list("nrstl"), 4))
    docs = [["".join(rng.choice(list("eaiou"), 7)) for _ in range(20)] for _ in range(400)]
    toxic = np.array([i % 5 == 0 for i in range(400)], np.int64)
    for i in range(0, 400, 5):
        docs[i] += ["scum", "scum"] if i % 20 else ["bdkp" + tail(), "bdkp" + tail()]
    model = toxicity.fit(docs, toxic)
    score = np.concatenate([s for _, _, s in toxicity.score_texts(pa.array([" ".join(d) for d in docs] + ["aeiouae bdkprrss oeaiuea bdkplnns"]), model)])
    assert ((score[:-1] >= toxicity.THRESHOLD) == (toxic == 1)).all() and score[-1] >= toxicity.THRESHOLD


def test_toxic_documents_of_every_language_are_found(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = toxicity.judged(docs, labels).where("held_out").join(labels.where("toxic is not null"), "doc_id").join(docs.select("doc_id", "lang"), "doc_id").collect()
    toxic = [r for r in held if r.toxic == 1]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    for lang in {r.lang for r in toxic}:
        own = [r.predicted for r in toxic if r.lang == lang]
        assert sum(own) >= 0.8 * len(own), lang
    clean = [r.predicted for r in held if r.toxic == 0]
    assert sum(clean) <= 0.02 * len(clean)


def test_quality_held_out(spark):
    docs, labels = _corpus(spark)
    got = quality_knn.judged(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)


def test_neighbours_are_exact():
    rng = np.random.default_rng(0)
    known = quality_knn.unit(rng.standard_normal((200, 8)).astype(np.float32))
    label = rng.integers(0, 2, 200)
    model = quality_knn.Model(np.ones(quality_knn.TERMS), np.eye(8, dtype=np.float32), known, label, label.mean())
    x = rng.standard_normal((20, 8)).astype(np.float32)
    cos = quality_knn.unit(x) @ known.T
    for c, s in zip(cos, model.score(x)):
        near = sorted(range(200), key=lambda i: -c[i])[:quality_knn.NEIGHBOURS]
        votes = [max(c[i], 0) ** 4 for i in near]
        assert s == pytest.approx(sum(v * label[i] for v, i in zip(votes, near)) / sum(votes), abs=1e-4)


def test_equal_texts_score_alike_in_any_place(spark, labels):
    rng = np.random.default_rng(3)
    known = quality_knn.Model(np.ones(quality_knn.TERMS), rng.standard_normal((quality_knn.TERMS, 8)), quality_knn.unit(rng.standard_normal((300, 8))), rng.integers(0, 2, 300))
    x = rng.random((200, quality_knn.TERMS)).astype(np.float32)
    x[::7] = x[0]
    whole = known.score(x)
    assert len(set(whole[::7])) == 1 and all(known.score(x[a:a + 13]).tolist() == whole[a:a + 13].tolist() for a in range(0, 200, 13))
    # Of equally near neighbours the first ones vote.
    same = quality_knn.Model(np.ones(quality_knn.TERMS), known.axes, np.repeat(known.known[:1], 300, axis=0), np.r_[np.ones(quality_knn.NEIGHBOURS), np.zeros(300 - quality_knn.NEIGHBOURS)].astype(int))
    assert set(same.score(np.abs(x[:20]))) <= {0.0, 1.0}


@pytest.mark.parametrize("judged", [toxicity.judged, quality_knn.judged])
def test_classifiers_take_odd_rows(spark, odd, labels, judged):
    got = judged(odd, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in ODD) and all(r.score is not None and 0 <= r.score <= 1 for r in got)
    assert all(r.held_out is not None for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 4)}) == 1
    assert judged(odd.limit(0), labels).count() == 0 and judged(odd, labels.limit(0)).count() == len(ODD)


# ---- 4 URLs --------------------------------------------------------------------------------------------------

URLS = [(1, "https://www.Example.ORG/es/1"), (2, "https://example.org/en/17"), (3, "https://example.org/fr/17"), (4, "http://a.com/fr/x?y=1&z=2#t"), (5, "http://a.com/de/x"),
        (6, "http://a.com/deli"), (7, "http://notexample.org/es/1"), (8, "no scheme"), (None, None), (10, "x://h"), (11, "http://casino-win.example.net/a"), (11, "http://casino-win.example.net/a"),
        (12, "http://org?a"), (13, "https://blog.free-bets.example.net/en/1"), (14, "https://quiet.example.net/en/1"), (15, "http://É.com/fr/")]


def _host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOW), re.match(r"[^?#]*", rest[len(host):])[0]


def test_url_rules_and_trees(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumn("host", F.lit("clash"))
    got = sorted((tuple(r) for r in url_filter.judged(pages, queries.URL_RULES).collect()), key=_key)
    want = []
    for page, url in URLS:
        host, path = _host_path(url)
        fit = [(len(h + p), h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want.append((page, host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else None))
    assert [r[:4] for r in got] == [w[:4] for w in sorted(want, key=_key)]
    by = {(r[0], r[1], r[2]): r[4] for r in got}
    assert all(by[w[:3]] == w[4] for w in want if w[4]) and set(by.values()) <= {"allow", "block"}
    assert url_filter.judged(pages.limit(0), queries.URL_RULES).count() == 0


def test_url_trees_learn_from_labels(spark):
    rows = [(f"http://{h}{i % 9}.example.net/en/{10 ** (i % 13)}", int(b)) for i in range(400) for h, b in (("plain", False), ("x9-7q-22", True))]
    labelled = spark.createDataFrame(rows, "url string, block int")
    pages = spark.createDataFrame([(1, "http://plainer.example.net/en/5"), (2, "http://x8-7q-31.example.net/en/55")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.judged(pages, [], labelled).collect()} == {1: "allow", 2: "block"}


# ---- 5 decontamination ---------------------------------------------------------------------------------------


def test_decontamination_finds_substituted_passages(spark, odd):
    rng = np.random.default_rng(5)
    vocab = [f"word{i}" for i in range(2000)]
    items = [[vocab[i] for i in rng.integers(0, 2000, n)] for n in (15, 20, 40, 60, 8)]
    docs, want = [], set()
    for i in range(120):
        w = [vocab[j] for j in rng.integers(0, 2000, 80)]
        if i % 3:
            item = list(items[i % 5])
            if i % 3 == 2 and len(item) >= 15:
                for j in range(rng.integers(7), len(item), 7):
                    item[j] = "changed"
            at = int(rng.integers(80))
            w[at:at] = [x.upper() + "," if rng.random() < 0.3 else x for x in item]
            want.add((i, i % 5))
        docs.append((i, " ".join(w)))
    tests = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(9, None), (10, "")], "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontamination.contaminated(frame, tests).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and all(r.identity >= 0.8 for r in got)
    for r in got:
        part = [x.strip(",").lower() for x in docs[r.doc_id][1].split()][r.start_word:r.end_word]
        assert sum(a == b for a, b in zip(part, items[r.item_id][r.item_start:])) == r.matched
    assert {r.doc_id for r in decontamination.decontaminated(frame, tests).collect()} == {i for i in range(120)} - {d for d, _ in want}


def test_stretches_with_substitutions_near_the_ends_are_found(spark):
    def brute(same, least):
        scores = [sum(1 if s else -4 for s in same[i:j]) for i in range(len(same)) for j in range(i + least, len(same) + 1) if same[i] and same[j - 1]]
        return max([x for x in scores if x >= 0], default=None)

    rng = np.random.default_rng(11)
    for _ in range(3000):
        n, least = int(rng.integers(1, 40)), int(rng.integers(1, 20))
        item = np.arange(1, n + 20, dtype=np.uint64)                # longer than the document, so never there as a whole
        same = rng.random(n) < rng.choice([0.3, 0.8, 0.95])
        first, end, matched = decontamination.best_stretch(np.where(same, item[:n], np.uint64(0)), item, 0, least)
        want = brute(same.tolist(), least)
        assert (want is None) == (matched == 0)
        if want is not None:
            assert end - first >= least and same[first] and same[end - 1] and matched == same[first:end].sum() and 5 * matched - 4 * (end - first) == want

    passages = ["=" * 12 + "x===", "========x====", "===x========x==", "==x=x========", "======x==x==x==", "=" * 13]       # parts of a longer item
    clean = ["=" * 11 + "xx", "=" * 12]
    item = [f"item{i}" for i in range(60)]
    docs = [(i, " ".join([*(f"a{i}n{k}" for k in range(30)), *(item[20 + k] if c == "=" else "changed" for k, c in enumerate(p)), *(f"b{i}n{k}" for k in range(30))]))
            for i, p in enumerate(passages + clean)]
    tests = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), tests).collect()
    assert {(r.doc_id, r.start_word, r.end_word - r.start_word, r.item_start, r.matched) for r in got} == {(i, 30, len(p), 20, p.count("=")) for i, p in enumerate(passages)}


def test_decontamination_odd_rows(spark, odd):
    tests = spark.createDataFrame([(1, PROSE), (None, "words that fill nothing at all in this odd table of rows")], "item_id long, text string")
    assert Counter(r.doc_id for r in decontamination.contaminated(odd, tests).collect()) == {1: 1, 4: 2, 5: 1}
    left = decontamination.decontaminated(odd, tests)
    assert left.columns == odd.columns and left.count() == len(ODD) - 4
    assert decontamination.contaminated(odd.limit(0), tests).count() == 0 and decontamination.contaminated(odd, tests.limit(0)).count() == 0


def test_items_of_one_id_and_passages_on_many_diagonals(spark):
    rng = np.random.default_rng(12)
    item = [f"v{k}" for k in rng.integers(0, 40, 30)]
    other = [f"u{k}" for k in rng.integers(0, 40, 20)]
    noise = lambda n: [f"n{k}" for k in rng.integers(0, 900, n)]
    changed = [*item[:4], "x", *item[5:]]
    words = noise(50) + changed + noise(7) + item + noise(9) + changed + item[:14] + noise(3) + other
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(noise(200)))], "doc_id long, text string")
    tests = spark.createDataFrame([(5, " ".join(item), "clash", 1), (5, " ".join(other), "clash", 1), (6, " ".join(other), "clash", 1)], "item_id long, text string, row string, diagonal int")
    got = sorted((r.doc_id, r.item_id, r.start_word, r.end_word, r.item_start, r.matched, r.identity) for r in decontamination.contaminated(docs, tests).collect())
    assert got == [(1, 5, 87, 117, 0, 30, 1.0), (1, 6, len(words) - 20, len(words), 0, 20, 1.0)]     # the best place, of both items of an id


# ---- 6 packing -----------------------------------------------------------------------------------------------


def test_packing(spark, odd):
    got = packing.pack_documents(odd, TOKENIZER, 1024, 2, with_ids=True).collect()
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == Counter(
        (d, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())) for d, t in ODD for ids in [_ids(t)] for s, n in _cuts(len(ids)))
    for _, rows in itertools.groupby(sorted(got, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        end = 0
        for r in rows:
            assert r.offset == end
            end += r.length
        assert end <= 1024
    assert packing.pack_documents(odd.limit(0), TOKENIZER).count() == 0
    whole = packing.sequences(packing.pack_documents(odd, TOKENIZER, 1024, 2, with_ids=True)).collect()
    assert sum(len(r.ids) for r in whole) == sum(len(_ids(t)) for _, t in ODD)


def _cuts(n):
    sizes = packing.cut(n, 1024)
    return list(zip([0, *itertools.accumulate(sizes)], sizes))


@pytest.mark.parametrize("seed", range(4))
def test_rounds_are_near_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    lengths = [rng.integers(1, 1025, 3000), np.minimum(1024, rng.geometric(0.01, 3000)), rng.integers(1, 512, 3000), np.full(3000, 341)][seed]
    size, n = np.unique(lengths, return_counts=True)
    runs = packing.best_fit_rounds(list(zip(size.tolist(), n.tolist())), 1024)
    order = np.sort(lengths)[::-1]
    fill, starts = Counter(), [r[0] for r in runs]
    for i, length in enumerate(order.tolist()):
        first, seq, offset = runs[np.searchsorted(starts, i, "right") - 1]
        assert fill[seq + i - first] <= 1024 - length or offset == fill[seq + i - first]
        fill[seq + i - first] += length
    assert max(fill.values()) <= 1024
    gaps: list[int] = []
    import bisect
    for length in order.tolist():
        k = bisect.bisect_left(gaps, length)
        left = (gaps.pop(k) if k < len(gaps) else 1024) - length
        bisect.insort(gaps, left)
    assert len(fill) <= 1.02 * len(gaps) + 1


# ---- 7 shards ------------------------------------------------------------------------------------------------


def test_shards(spark, odd):
    got = sorted((tuple(r) for r in sharding.shards_of(odd, 5, 11).collect()), key=_key)
    rows = sorted(((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in ODD), key=lambda r: ((r[0] is not None, r[0]), r[2], r[1]))
    want = sorted(((*r, *sharding.place(i, len(rows), 5, 11)) for i, r in enumerate(rows)), key=_key)
    assert got == want
    assert sharding.shards_of(odd.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_permutation(n):
    places = {sharding.place(i, n, 24, 5) for i in range(n)}
    count = Counter(s for s, _ in places)
    assert len(places) == n and max(count.values()) - min(count.get(s, 0) for s in range(24)) <= 1
    assert all({slot for s, slot in places if s == shard} == set(range(c)) for shard, c in count.items())


# ---- 8 line labels -------------------------------------------------------------------------------------------


def _base(text):
    t = text or ""
    w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), sum(x in lines[:i] for i, x in enumerate(lines)), len(inside)


def test_line_labels(spark, odd, labels):
    extra = [(20, "x\n\nx\n x\n\nx\r\nx\r"), (21, "a b c d e f g h a b c d e f g h"), (22, "# # # *** <b>"), (23, PROSE.replace(" ", "\n") * 2)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = line_crf.judged(docs, labels).collect()
    measures = lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    assert Counter((r.doc_id, measures(r)) for r in got) == Counter((d, _base(t)) for d, t in ODD + extra)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept)
    assert line_crf.judged(docs.limit(0), labels).count() == 0 and line_crf.judged(docs, labels.limit(0)).where("kept").count() > 0


def test_field_learns_from_long_documents(spark):
    """Every good document is longer than a chain; all its lines are fitted on."""
    good, bad = ("Some plain words that end well, number %d of a long text.\n", "<a> | $$ %% ## %d\n")
    docs = spark.createDataFrame([(i, "".join(kind % (1000 * i + j) for j in range(600))) for i, kind in ((1, good), (2, bad), (3, good), (4, bad))], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    cut = line_crf.chains(docs, labels).collect()
    assert sorted((r.doc_id, r.chain, len(r.x) // 4 // line_crf.FEATURES) for r in cut) == [(d, c, min(256, 600 - 256 * c)) for d in (1, 2) for c in (0, 1, 2)]
    assert line_crf.chains(docs, labels, per_chains=2).count() == 4
    assert {r.doc_id: r.content_words > 0.9 * r.n_words for r in line_crf.decoded(docs, line_crf.train(docs, labels)).collect()} == {1: True, 2: False, 3: True, 4: False}


def test_field_gradient_and_viterbi():
    rng = np.random.default_rng(0)
    x, y, row = rng.normal(size=(12, line_crf.FEATURES)), rng.integers(0, 2, 12), np.array([0, 0, 0, 1, 2, 2, 2, 2, 2, 4, 4, 4])
    weight, line, pair = np.array([1.0, 2, 0.5, 1, 1.5]), rng.normal(size=(line_crf.FEATURES, 2)), rng.normal(size=(2, 2))
    loss, g_line, g_pair = line_crf._gradient(x, y, row, weight, line, pair)
    for base, grad, at in ((line, g_line, (3, 1)), (pair, g_pair, (0, 1))):
        moved = base.copy()
        moved[at] += 1e-6
        args = (moved, pair) if base is line else (line, moved)
        assert (line_crf._gradient(x, y, row, weight, *args)[0] - loss) / 1e-6 == pytest.approx(grad[at], abs=1e-4)
    label = line_crf.Field(line, pair).viterbi(x, row)
    for r in set(row.tolist()):
        at = np.flatnonzero(row == r)
        score = x[at] @ line
        best = max(itertools.product((0, 1), repeat=len(at)), key=lambda p: sum(score[i, p[i]] for i in range(len(p))) + sum(pair[p[i - 1], p[i]] for i in range(1, len(p))))
        assert tuple(label[at]) == best


# ---- 9 licences ----------------------------------------------------------------------------------------------


def test_licenses(spark, odd):
    docs = [(1, "Some text. Licensed under the Apache License, Version 2.0. More text follows here."), (2, "licensed under cc by-sa 4.0 and nothing else"),
            (3, "This work is licensed under the GNU General Public License,\nversion 3."), (4, "He has the rights to drive; a licence was issued and released."),
            (5, PROSE * 50 + "All rights reserved. " + PROSE * 50 + "Released under the MIT License."), (6, "Use of this source code is governed by a BSD style licence that can be found in the LICENSE file."),
            (None, "All rights reserved."), (7, "Licensed under CC BY-NC 4.0."), (7, "Licensed under CC BY-NC 4.0.")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").unionByName(odd.where("doc_id is not null").select((F.col("doc_id") + 100).alias("doc_id"), "text"))
    got = license_scan.licenses(frame).collect()
    assert Counter((r.doc_id, r.license) for r in got) == Counter(
        [(1, "Apache-2.0"), (2, "CC-BY-SA-4.0"), (3, "GPL-3.0"), (5, "proprietary"), (5, "MIT"), (6, "BSD-3-Clause"), (None, "proprietary"), (7, "CC-BY-NC-4.0"), (7, "CC-BY-NC-4.0")])
    at = {(r.doc_id, r.license): r for r in got}
    r = at[(1, "Apache-2.0")]
    assert docs[0][1].split()[r.start_word:r.end_word] == "Licensed under the Apache License, Version 2.0.".split() and r.differences == ""
    assert "licence" in at[(6, "BSD-3-Clause")].differences and at[(6, "BSD-3-Clause")].coverage < 1
    assert license_scan.licenses(frame.limit(0)).count() == 0
    clash = odd.withColumn("license", F.lit(1)).withColumn("coverage", F.lit("x")).withColumn("text", F.when(F.col("doc_id") == 4, F.concat("text", F.lit("All rights reserved."))).otherwise(F.col("text")))
    assert [(r.doc_id, r.license, r.coverage) for r in license_scan.licenses(clash).collect()] == [(4, "proprietary", 1.0)] * 2


def test_licenses_of_one_block_are_all_found():
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    names = ["GPL-3.0", "MIT", "proprietary", "CC-BY-NC-4.0", "MPL-2.0", "GPL-2.0", "proprietary", "MIT"]
    for n in range(2, len(names) + 1):
        for gap in ("", "and here are some fifteen other words that say nothing at all about it today so"):
            block = license_scan.plain(f" {gap} ".join(license_scan.TEMPLATES[x] for x in names[:n]))
            got = scanner.scan(block)
            assert [h[0] for h in sorted(got, key=lambda h: h[1])] == names[:n] and all(h[3] == 1 for h in got)
    block = license_scan.plain("licensed under cc by-nc 4.0 " + "filler " * 15 + "all rights reserved")
    assert {h[0] for h in scanner.scan(block)} == {"CC-BY-NC-4.0", "proprietary"}


def test_licenses_repeated_and_changed(spark):
    bsd = license_scan.TEMPLATES["BSD-3-Clause"]
    docs = [(1, " ".join(["All rights reserved."] * 5)), (2, " ".join(["All rights reserved. Released under the MIT License."] * 60)),
            (3, f"{bsd.replace('Use of', 'Usage of')} {bsd.replace('found in', 'seen in')} {bsd}"),
            (4, " ".join(license_scan.TEMPLATES["GPL-3.0"] + " " + "word " * (i % 7) for i in range(100)))]
    got = license_scan.licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.license) for r in got) == {(1, "proprietary"): 5, (2, "proprietary"): 60, (2, "MIT"): 60, (3, "BSD-3-Clause"): 3, (4, "GPL-3.0"): 100}
    assert sorted(r.coverage for r in got if r.doc_id == 3) == [0.947368, 0.947368, 1.0] and all(r.coverage == 1 for r in got if r.doc_id == 4)


def test_licenses_long_texts_across_block_edges(spark):
    rng = np.random.default_rng(3)
    docs, want = [], Counter()
    for i, (name, text) in enumerate(license_scan.TEXTS.items()):
        for j in range(3):
            noise = " ".join(["licence"] + [f"w{k}" for k in rng.integers(0, 500, 400 + 613 * j)] + ["rights"] * (j * 1700))     # cues make one long range of blocks
            lines = " ".join(w if k % 9 else f"* {w}" for k, w in enumerate(text.split()))                                     # comment marks between the words
            docs.append((10 * i + j, f"{noise} {lines} and {text.replace('License', 'Licence', 1).replace('copy', 'duplicate', 1)} {noise}"))
            want[10 * i + j, name] = 2
    edge = [f"t{k}" for k in range(200)]
    edge[100] = "rights"
    cut = spark.createDataFrame([(k, " ".join(["rights"] * k + edge + ["x"] * 300)) for k in (0, 700, 1500, 1599, 1700, 1800, 1999)], "doc_id long, text string")
    assert sorted((r.doc_id, r.start_word, r.end_word) for r in license_scan.licenses(cut, {"own": " ".join(edge)}).collect()) == [(k, k, k + 200) for k in (0, 700, 1500, 1599, 1700, 1800, 1999)]
    got = license_scan.licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.license) for r in got) == want
    for r in got:
        words = docs[[d for d, _ in docs].index(r.doc_id)][1].split()
        if r.coverage == 1:
            assert license_scan.plain(" ".join(words[r.start_word:r.end_word])) == license_scan.plain(license_scan.TEXTS[r.license])


def _damaged(words, enough, rng):
    """A notice of these words that lacks or changes as many as it may."""
    out = list(words)
    for p in rng.choice(len(out), len(out) - enough, replace=False):
        out[p] = None if rng.random() < 0.3 else "".join(rng.choice(list("abcdefghijkl"), int(rng.integers(2, 9))))
    return [w for w in out if w]


def test_licenses_equal_the_alignment_of_every_template_everywhere(spark):
    rng = np.random.default_rng(9)
    pairs = [*license_scan.TEMPLATES.items(), *license_scan.TEXTS.items()]
    scanner = license_scan.Scanner(pairs)
    filler = PROSE.lower().replace(".", "").split() + ["licensed", "software", "rights", "merchantability", "documentation", "reserved"]
    docs, want = [], []
    for d in range(40):
        words = []
        for t in rng.integers(0, len(pairs), 4).tolist():
            words += rng.choice(filler, int(rng.integers(0, 60))).tolist()
            words += _damaged(scanner.words[t], scanner._enough[t], rng) if rng.random() < 0.7 else scanner.words[t]
        docs.append((d, " ".join(words)))
        everywhere = [(name, first, end, cover, 0, diff, round((3 * cover - 1) * len(scanner.words[t])) - (end - first))
                      for t, name in enumerate(scanner.names) for cover, first, end, diff in scanner.confirm(words, t)]
        want += [(d, h[0], h[1], h[2], h[5]) for h in license_scan.resolved(everywhere)]
    got = license_scan.licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(want) > 120
    assert sorted((r.doc_id, r.license, r.start_word, r.end_word, r.differences) for r in got) == sorted(want)


def test_allowed_damage_keeps_a_cue_and_clears_the_floor():
    rng = np.random.default_rng(4)
    scanner = license_scan.Scanner([*license_scan.TEMPLATES.items(), *license_scan.TEXTS.items()])
    for t, words in enumerate(scanner.words):
        if len(words) < license_scan.SHORT:
            continue
        for _ in range(60):
            left = PROSE.lower().split()[:int(rng.integers(0, 20))]
            doc = left + _damaged(words, scanner._enough[t], rng) + PROSE.lower().split()
            met = [(i, w) for i, w in enumerate(doc) if w in scanner.cues]
            blocks = [(k, lo, doc[lo:hi]) for k, lo, hi in scanner.blocks(met, len(doc))]
            assert t in {w[1] for w in scanner.winners(blocks)}


def test_compression_decides_which_templates_are_aligned(monkeypatch):
    scanner = license_scan.Scanner([*license_scan.TEMPLATES.items(), *license_scan.TEXTS.items()])
    aligned = []
    monkeypatch.setattr(license_scan.Scanner, "confirm", lambda self, block, t: aligned.append(t) or [])
    long = {t for t, p in scanner.cues["merchantability"]}
    doc = license_scan.plain(f"{PROSE * 10} merchantability {PROSE * 10}")       # a cue of several templates, and nothing else of them
    assert len(long) >= 3 and long == {b[0] for b in scanner.blocks([(doc.index("merchantability"), "merchantability")], len(doc))}
    assert scanner.scan(doc) == [] and not long & set(aligned)
    aligned.clear()
    scanner.scan(license_scan.plain(PROSE + license_scan.TEMPLATES["GPL-3.0"] + PROSE))
    assert scanner.names[aligned[0]] == "GPL-3.0" and not long & set(aligned)     # the most telling first
    monkeypatch.setattr(license_scan, "FLOOR", -math.inf)
    aligned.clear()
    scanner.scan(doc)
    assert long <= set(aligned)


def test_license_templates_without_usual_words(spark):
    own = " ".join(f"clause{k % 7} item{k}" for k in range(30))
    docs = spark.createDataFrame([(1, PROSE + own + " " + PROSE), (2, PROSE), (3, PROSE + "all\u00a0rights\u00a0reserved.")], "doc_id long, text string")
    assert [(r.doc_id, r.license, r.coverage) for r in license_scan.licenses(docs, {"own": own}).collect()] == [(1, "own", 1.0)]
    assert [(r.doc_id, r.license) for r in license_scan.licenses(docs).collect()] == [(3, "proprietary")]
    with pytest.raises(ValueError):
        license_scan.licenses(docs, {"empty": " ... "})


# ---- what an operator must not lose --------------------------------------------------------------------------


def test_every_allowed_substitution_leaves_a_seed():
    """All substitutions with at least 80 % of an item's words equal, for every length that has lighter masks, and some beyond."""
    for n in range(1, 19):
        masks = decontamination.MASKS + decontamination.LIGHT_MASKS.get(n, ())
        for k in range(n // 5 + 1):
            for gone in itertools.combinations(range(n), k):
                assert any(all(not (c == "1" and i + at in gone) for i, c in enumerate(m)) for m in masks for at in range(n - len(m) + 1)), (n, gone)


def test_short_items_are_found(spark):
    tests = spark.createDataFrame([(1, "Quartz"), (2, "blue whale sings"), (3, "one two three four five"), (4, "never odd or even again"), (5, "")], "item_id long, text string")
    docs = [(1, "a piece of quartz, found"), (2, "the Blue whale sings loud"), (3, "count one two 3 four five now"), (4, "blue whales sing"), (5, "never odd nor even"), (6, None), (7, "")]
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), tests).collect()}
    assert got == {(1, 1), (2, 2), (3, 3)}


def test_join_of_sets_far_apart_in_size_is_refused(spark):
    with pytest.raises(ValueError):
        jaccard_join.near_duplicates(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), 3, 40)


def test_pieces_of_two_generations_are_remembered(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", 50)
    enc, texts = tokens.PieceEncoder(TOKENIZER), [" ".join(f"w{i}x{j} common" for j in range(40)) + " end" for i in range(6)]
    for t in texts:
        (_, _, flat, _), = enc.encode(pa.array([t]))
        assert flat.tolist() == _ids(t)[:-1]
    assert len(enc._memo) <= 50 + 90 and len(enc._older) <= 50 + 90 and enc._older


def test_new_pieces_share_calls_of_the_model():
    class Counted:
        def __init__(self, model):
            self.model, self.calls = model, 0

        def tokenize(self, text):
            self.calls += 1
            return self.model.tokenize(text)

    texts = ["", " ".join(f"{chr(97 + i % 26)}ord{chr(97 + i // 26)} Ünï{chr(97 + i % 26)}{chr(97 + i // 26)}ß" for i in range(600)), None, "a1b2 don't 50% ×÷ À ÿ\x00z नमस्ते 😀, x" + "y" * 3000 + ". ²½"]
    want = [_ids(t)[:-1] for t in texts]
    for gap in (True, False):                   # without a letter to part them, one pre-token a call
        enc = tokens.PieceEncoder(TOKENIZER)
        enc._model = Counted(enc._model)
        if not gap:
            enc._gap_id = None
        for _ in range(2):                      # the second time all are remembered
            (_, _, flat, per), = enc.encode(pa.array(texts))
            at = np.r_[0, np.cumsum(per)]
            assert [flat[at[i]:at[i + 1]].tolist() for i in range(len(texts))] == want
        assert (enc._model.calls < 100) if gap else (enc._model.calls > 1000)


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_members_without_a_partner_for_their_place_leave_a_region(percent):
    rng = np.random.default_rng(percent)
    for _ in range(300):
        m = int(rng.integers(1, 30))
        region, n = np.sort(rng.integers(0, 5, m)), rng.integers(1, 2000, m)
        n[rng.random(m) < 0.5] = 100
        n = n[np.lexsort((n, region))]
        nth = (rng.random(m) * jaccard_join.kept_shingles(n, percent)).astype(int)
        exact = jaccard_join.largest_partner(n, nth, percent)
        most = jaccard_join.reached(n, jaccard_join.reach(n, nth, percent), percent)
        assert (most >= exact).all() and (most <= n * 100 // percent).all()
        for far in (exact, most):
            want = [any(i != j and region[i] == region[j] and n[j] <= far[i] and n[i] <= far[j] for j in range(m)) for i in range(m)]
            assert jaccard_join.with_partner(np.unique(region, return_inverse=True)[1], n, far).tolist() == want
    # Two sets of 100 share at most 100 - nth shingles if the nth is the first: 89 of 200 in all for 80 %.
    assert jaccard_join.largest_partner(np.array([100, 100]), np.array([11, 12]), 80).tolist() == [100, 98]


def test_rows_of_keys_stay_where_they_are(spark):
    docs = spark.range(0, 1000, 1, 7).selectExpr("id % 10 AS doc_id", "concat('text ', id) AS text", "array(id) AS more")
    rows = common.pin(docs.withColumn("key", F.monotonically_increasing_id()), "test-rows")
    wanted = rows.where("text LIKE '%7' AND key < 40000000000").select("key")
    got = common.rows_of_keys(rows, "key", wanted)
    assert got.schema == rows.schema and "Exchange" not in got._jdf.queryExecution().toString()
    assert Counter(r.text for r in got.collect()) == Counter(r.text for r in rows.join(wanted, "key").collect()) != Counter()
    assert common.rows_of_keys(rows, "key", wanted.limit(0)).count() == 0


def test_pinned_tables_leave_no_shuffle_files(spark):
    held = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    before, conf = held(), spark.conf.get(common.SHUFFLE_CLEANUP, None)
    pinned = common.pin(spark.range(1000).repartition(5), "test-shuffles")
    until = time.time() + 20
    while held() - before and time.time() < until:      # they are removed in the background
        time.sleep(0.2)
    assert not held() - before
    assert spark.conf.get(common.SHUFFLE_CLEANUP, None) == conf and pinned.count() == 1000
