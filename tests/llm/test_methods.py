"""Operators against brute force, exact round trips and held-out accuracy."""

import math
import os
import random
import re
import tracemalloc
import unicodedata
import zlib

import numpy as np
import pytest
import public_tokenizers
from oracle_check import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer
import xxhash

import __spark_entry__ as entry
import corpus_pipeline
from creditloom.llm import chat, components, decontaminate, language_id, packing, pii, simhash, topk, toxicity, warc
from creditloom.llm.queries import ORACLE, QUERIES

SMALL, MIDDLE, LARGE = (f"/root/testdata/sf{n}" for n in ("0.001", "0.01", "0.1"))
given = pytest.mark.skipif(not os.path.isdir(SMALL), reason="given tables are not here")


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()


# --- all queries ------------------------------------------------------------------------------------


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()


@given
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    assert compare(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name]) is None


@given
@pytest.mark.parametrize("name", ["op7_pii", "op10_line_dedup"])
def test_native(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


# --- packing ----------------------------------------------------------------------------------------


@given
def test_packing(spark):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {
        r.doc_id: np.array([*plain.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for r in documents(spark, SMALL)
    }
    pieces = QUERIES["op4_packing"](spark, SMALL).collect()
    at = dict.fromkeys(ids, 0)
    for p in sorted(pieces, key=lambda p: p.start):
        assert p.start == at[p.doc_id] and p.doc_tokens == len(ids[p.doc_id]) and p.length > 0
        at[p.doc_id] += p.length
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : at[p.doc_id]].tobytes())
    assert at == {d: len(x) for d, x in ids.items()}
    fill = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == fill.get(p.sequence_id, 0)
        fill[p.sequence_id] = p.offset + p.length
    assert max(fill.values()) <= 1024
    assert sum(n < 1024 for n in fill.values()) <= spark.sparkContext.defaultParallelism


ODD = ["", " ", "  a", "a  b", "a \n b", "x\t y", "tab\t\tz  ", "é ü  w", "<|endoftext|>", "a <|endoftext|> b", "日本 語", "🙂 🙂x", "don't  stop", "  q", "1 2  3 "]


def test_word_encoder():
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made = packing.WordEncoder("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    rng = random.Random(5)
    mixed = ["".join(rng.choice("ab ,.\n\t'é日🙂 1") for _ in range(40)) for _ in range(300)]
    for text in ODD + mixed:
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(made.encode(text), dtype="<u4").tolist() == want, text


def test_packer_pads_the_last_window_only():
    rng = random.Random(1)
    packer, full, total = packing.Packer(64, 4), [], 0
    for row in range(500):
        n = rng.choice([1, 5, 30, 63, 64, 65, 300])
        total += n
        full += packer.place(row, bytes(4 * n))
        assert len(packer.open) <= 4
    full += packer.finish()
    sizes = [sum(len(p[2]) // 4 for p in w) for w in full]
    assert sum(sizes) == total and all(s == 64 for s in sizes[:-1])


# --- SimHash ----------------------------------------------------------------------------------------


def plain_fingerprint(text):
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", fold)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, reach=4):
    parent = {f: f for f in fps}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    fps = sorted(parent)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= reach:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


@given
def test_simhash(spark):
    docs = documents(spark, SMALL)
    fps = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    roots = plain_components(set(fps.values()))
    least = {}
    for d, f in fps.items():
        least[roots[f]] = min(d, least.get(roots[f], d))
    for r in QUERIES["op5_simhash"](spark, SMALL).collect():
        assert r.fingerprint == f"{fps[r.doc_id]:016x}"
        assert r.component_id == least[roots[fps[r.doc_id]]]


@pytest.mark.parametrize("dense", [3, 64])
def test_links_of_dense_groups(spark, dense):
    rng = random.Random(7)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    fps = {rng.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1}
    for centre in rng.sample(sorted(fps), 3):
        at = centre
        for _ in range(120):  # a cloud around the centre, and a chain away from it
            flips = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            fps.add(centre ^ flips)
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            fps.add(at)
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    links = simhash.links(frame, dense=dense)
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 4 and r.a > r.b for r in links.collect())
    got = {r.node: r.root for r in components.components(links).collect()}
    want = plain_components(fps)
    groups = {}
    for f, root in want.items():
        groups.setdefault(root, set()).add(signed(f))
    for group in groups.values():
        assert {got.get(f, f) for f in group} == {min(group)}


def test_links_in_one_full_cell(spark):
    rng = random.Random(8)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    # one bit in each segment: all have the same counts, most are far apart
    fps = {sum(rng.choice((1, 2)) << 2 * i for i in range(32)) for _ in range(300)}
    fps |= {f ^ 0b11 << 2 * rng.randrange(32) for f in sorted(fps)[:40]}
    fps |= {f ^ 1 << rng.randrange(64) for f in sorted(fps)[:40]}
    found = simhash.links(spark.createDataFrame([(signed(f),) for f in fps], "fp long"))
    got = {r.node: r.root for r in components.components(found).collect()}
    groups = {}
    for f, root in plain_components(fps).items():
        groups.setdefault(root, set()).add(signed(f))
    assert sum(len(g) > 1 for g in groups.values()) > 20
    for group in groups.values():
        assert {got.get(f, f) for f in group} == {min(group)}


def test_meetings_of_random_fingerprints(spark):
    n = 40_000
    fps = np.unique(np.random.default_rng(5).integers(-(1 << 63), (1 << 63) - 1, n)).tolist()
    cells = simhash._cells(spark.createDataFrame([(f,) for f in fps], "fp long"))
    size = F.col("count")
    met = cells.groupBy("cell").count().agg(F.sum("count"), F.sum(size * (size - 1) / 2)).first()
    assert met[0] < 102 * n and met[1] < n * n / 400_000


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i + 1, i) for i in range(1, 60)] + [(1000 + i, 100) for i in range(50)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 61)} == {1} and {got[1000 + i] for i in range(50)} == {100}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- others -----------------------------------------------------------------------------------------


def test_top_k_reads_lists(spark):
    rng = np.random.default_rng(3)
    vectors = rng.integers(-50, 50, size=(400, 6))
    vectors[10:40] = vectors[10]
    ids = np.arange(400)
    block = topk.Block(vectors.astype(np.int64))
    rows = list(zip(ids.tolist(), vectors.tolist()))
    want = topk.brute_force(rows, [0, 10, 11, 399], 10)
    got = []
    for own in (0, 10, 11, 399):
        best, scores = block.best(vectors[own].astype(np.int64), ids, own, 10)
        got += [(own, r + 1, int(i), int(s)) for r, (i, s) in enumerate(zip(best, scores))]
    assert got == want
    assert len(block.survivors(vectors[0].astype(np.int64) * 1, 10)) < 400


def test_top_k_queries_read_lists_together(monkeypatch):
    rng = np.random.default_rng(5)
    vectors = np.concatenate([rng.integers(-90, 90, size=(500, 16)), rng.integers(-(1 << 60), 1 << 60, size=(6, 16))])
    vectors[20:60] = vectors[20]
    ids = np.concatenate([np.arange(500) % 490, np.arange(500, 506)])
    asked = np.concatenate([np.arange(30), np.arange(490, 506), [489] * 4])
    block = topk.Block(vectors)
    reads = []
    read = block._read
    block._read = lambda weights, *rest: reads.append(len(weights)) or read(weights, *rest)
    for k in (1, 10, 200):
        got = list(block.best_of(vectors[asked], ids, ids[asked].tolist(), k))
        for i, (found, scores) in zip(asked, got):
            products = [(-sum(int(a) * int(b) for a, b in zip(vectors[i], v)), int(j)) for j, v in zip(ids, vectors) if j != ids[i]]
            assert [(-int(s), int(j)) for j, s in zip(found, scores)] == sorted(products)[:k]
    # 50 queries in four parts, the one of long and short numbers read on its own for either
    assert sum(reads) == 3 * len(asked) and len(reads) <= 3 * 5
    assert list(topk.Block(vectors[:0]).best_of(vectors[:0], ids[:0], [], 3)) == []


def test_top_k_looks_where_queries_end():
    """Looks at bounds that no query ends at are left out for the queries that follow, and come back."""
    rng = np.random.default_rng(6)
    near = rng.normal(size=(2000, 40))
    values = np.floor(1024 * near / np.linalg.norm(near, axis=1)[:, None]).astype(np.int64)
    values[:, 0] += 5000 * (np.arange(2000) == 7)
    block = topk.Block(values)
    list(block.best_of(values[100:140], np.arange(2000), list(range(100, 140)), 5))
    late = block.first
    assert late > 0
    easy = np.zeros((400, 40), dtype=np.int64)
    easy[:, 0] = 1 + np.arange(400)
    assert all(found.tolist() == [7] for found, _ in block.best_of(easy, np.arange(2000), [-1] * 400, 1))
    assert block.first < late


def test_top_k_over_many_blocks(spark):
    rng = random.Random(9)
    rows = [(i, [float(rng.randint(-40, 40)) for _ in range(rng.choice([0, 3, 5, 5, 5]))]) for i in range(300)]
    rows += [(20, [1.0, 2.0]), (20, [-3.0]), (21, rows[21][1]), (40, rows[40][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asks = F.col("vec_id") % 20 == 0
    got = topk.top_k(frame, asks, k=4, scale=1, candidates=25, queries=6).collect()
    want = []
    for own, q in {(i, tuple(v)) for i, v in rows if i % 20 == 0}:
        scored = sorted((-sum(int(a) * int(b) for a, b in zip(q, v)), i) for i, v in rows if i != own)[:4]
        want += [(own, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_copies(spark):
    rows = spark.range(2000).select(
        "id", (F.col("id") % 100 == 0).alias("asks"), F.array(F.col("id"), F.col("id") * 7).alias("v")
    )
    dealt, blocks, asking = topk._dealt(rows, 100, 10)
    assert (blocks, asking) == (20, 2)
    assert {r.role: r["count"] for r in dealt.groupBy("role").count().collect()} == {0: 2000 * 2, 1: 20 * 20}
    assert dealt.select("pair").distinct().count() == 40


def plain_words(text):
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold)


def plain_windows(texts, window):
    items = [plain_words(t) for t in texts]
    exact = {tuple(w[i : i + min(window, len(w))]) for w in items if w for i in range(max(1, len(w) - window + 1))}
    return exact, {len(w) for w in exact}


def test_windows_of_equal_hashes_are_told_apart(monkeypatch):
    # with one hash for all words, only the comparison of words is left
    monkeypatch.setattr(decontaminate, "_word_hashes", lambda words: np.ones(len(words), dtype=np.uint64))
    rng = random.Random(6)
    word = lambda: rng.choice("abc")
    items = [(f"i{i % 20}" if i else None, " ".join(word() for _ in range(rng.choice([0, 2, 4, 6])))) for i in range(25)]
    texts = [None, "", *(" ".join(word() for _ in range(rng.randrange(12))) for _ in range(60))]
    known = decontaminate.WindowSet(items, 4)
    for text, (n_words, spans, named) in zip(texts, decontaminate.scan_texts(texts, known)):
        words = plain_words(text)
        hit, found = set(), set()
        for item_id, item in items:
            exact, sizes = plain_windows([item], 4)
            for n in sizes:
                for i in range(len(words) - n + 1):
                    if tuple(words[i : i + n]) in exact:
                        hit.update(range(i, i + n))
                        found.add(item_id)
        assert n_words == len(words)
        assert {i for a, b in spans for i in range(a, b)} == hit
        assert named == sorted(found - {None})


def test_memory_of_a_full_slice():
    per_item = 2 * 60 * 6 + decontaminate.WORD_BYTES * 61
    rng = np.random.default_rng(4)
    n = decontaminate.SLICE_BYTES // per_item
    letters = rng.integers(97, 123, size=(n, 60, 6), dtype=np.uint8)
    letters[:, :, 5] = 32
    items = [(str(i), letters[i].tobytes().decode()) for i in range(n)]
    del letters
    tracemalloc.start()
    try:
        known = decontaminate.WindowSet(items, 10)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    text = sum(len(t) for _, t in items)
    assert known.nbytes + text <= decontaminate.SLICE_BYTES and peak + text < 300 << 20
    text = "x " + items[n // 2][1] + " y"
    assert decontaminate.scan_texts([text], known) == [(62, [(1, 61)], [str(n // 2)])]


def test_benchmark_beyond_one_slice(spark):
    rng = random.Random(2)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop")
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 9, 10, 14])))) for i in range(30)]
    docs = [(i, " ".join(word() for _ in range(40)) + " | " + rng.choice(items)[1].upper() + "!") for i in range(40)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(str(r) for r in decontaminate.scan(d, b).collect())
    assert whole == sorted(str(r) for r in decontaminate.scan(d, b, slice_bytes=500).collect())
    cut = decontaminate.remove_contaminated(d, b, spans_only=True)
    assert decontaminate.remove_contaminated(cut, b).count() > 0
    assert decontaminate.scan(d, b).where(F.size("hits.spans") == 0).count() == 0


def test_personal_data(spark):
    text = (
        "mail a.b@c.de_x@y.org, ip 1.2.3.4.5.6.7.8 and 999.1.1.1; card 4111 1111 1111 1111 or 4111111111111112 "
        "call +49 (30) 123-4567 é IBAN DE89370400440532013000 or DE89370400440532013001; SSN 123-45-6789"
    )
    frame = spark.createDataFrame([(1, text), (2, "1" * 30_000 + "@" + "a" * 30_000)], "doc_id long, text string")
    out = {r.doc.doc_id: r.spans for r in pii.find_spans(frame).collect()}
    found = [(s.kind, text[s.start : s.end]) for s in out[1]]
    assert found == [
        ("email", "a.b@c.de"), ("email", "_x@y.org"), ("ip", "1.2.3.4"), ("ip", "5.6.7.8"),
        ("card", "4111 1111 1111 1111"), ("phone", "+49 (30) 123-4567"),
        ("iban", "DE89370400440532013000"), ("ssn", "123-45-6789"),
    ]
    assert out[2] == []


def test_account_codes_end_at_their_length(spark):
    code, grouped, dutch = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "NL91ABNA0417164300"
    cases = [
        (f"{code} BIC COBADEFFXXX", [code]),
        (f"{grouped} Please confirm", [grouped]),
        (f"{code} 2024", [code]),
        (f"é {code} {dutch} {grouped} {code}", [code, dutch, grouped, code]),
        (f"SE10 {grouped} and GB12{code}", [grouped, code]),  # begins like a code, but isn't one
        (f"{code}1 {code}x {code}é", []),
        ("XX89370400440532013000 DE89370400440532013001 DE8937040044", []),
        ("DE89" * 2000 + f" {code}", [code]),
    ]
    frame = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "doc_id long, text string")
    out = {r.doc.doc_id: r.spans for r in pii.find_spans(frame).collect()}
    for i, (text, want) in enumerate(cases):
        assert [text[s.start : s.end] for s in out[i] if s.kind == "iban"] == want, text[:60]


@given
def test_language_held_out(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    out = [r for r in QUERIES["op9_language_id"](spark, MIDDLE).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in out)


def test_language_of_few_texts_is_learned(spark):
    """Copies and texts without a word take no share of the sample away from a language's other texts."""
    french = ["le chat est sur la table", "nous avons une maison", "il fait beau aujourd'hui"]
    rows = [(french[i % 3], "fr") for i in range(900)] + [(f"{i} --- {i}", "fr") for i in range(900)]
    rows += [(f"the cat number {chr(97 + i % 26) * (1 + i // 26)} sat on the mat", "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = language_id.learn(docs, sample=10)
    assert model.languages == ["en", "fr"]
    assert np.allclose(np.exp(model.prior), [300 / 2100, 1800 / 2100])
    out = language_id.predict(docs, model).where("lang_pred <> 'und'")
    assert {tuple(r) for r in out.select("doc.text", "lang_pred").where("doc.lang = 'fr'").distinct().collect()} == {(t, "fr") for t in french}


def test_language_sample_counts_copies_as_weight(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(language_id, "fit", lambda counts, rows, pieces: seen.update(counts=counts, rows=rows))
    rows = [("hot hot text", "en")] * 500 + [(f"w{chr(97 + i % 26) * (1 + i // 26)}", "en") for i in range(99)]
    docs = spark.createDataFrame(rows + [("12", "en")] * 7, "text string, lang string")
    language_id.learn(docs, sample=100)
    assert seen["rows"] == {"en": 606} and len(seen["counts"]["en"]) == 101
    assert seen["counts"]["en"]["hot"] == 1000 and seen["counts"]["en"]["text"] == 500 and seen["counts"]["en"]["wa"] == 1


def test_segmentations_are_summed():
    pieces = [" ", " a", "a", "ab", "b", " ab"]
    lattice = language_id.Lattice(pieces)
    p = np.array([[0.1], [0.2], [0.3], [0.15], [0.05], [0.1], [0.02]])
    by = {x: p[i, 0] for i, x in enumerate(pieces)}

    def ways(word):
        return 1.0 if not word else sum(by.get(word[:n], 0.02 if n == 1 else 0) * ways(word[n:]) for n in range(1, len(word) + 1))

    words = ["ab", "aab", "ba", "zb"]
    got = language_id.word_scores(lattice, p, words)[:, 0]
    assert np.allclose(got, [math.log(ways(" " + w)) for w in words])


@given
def test_toxicity_held_out(spark):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    out = [r for r in QUERIES["op1_toxicity"](spark, LARGE).collect() if r.doc_id in toxic]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    held = [(r.predicted, toxic[r.doc_id], r.score) for r in out if r.held_out]
    caught, positives = (sum(t for p, t, _ in held if p >= least) for least in (1, 0))
    named = sum(p for p, _, _ in held)
    # a bound on recall and on precision
    assert positives >= 50 and caught >= 0.85 * positives and caught >= 0.85 * named
    # the area under the curve
    toxic_scores, others = ([s for _, t, s in held if t == kind] for kind in (1, 0))
    above = sum((a > b) + 0.5 * (a == b) for a in toxic_scores for b in others)
    assert above >= 0.85 * len(toxic_scores) * len(others)

def test_mixed_masks_are_seen():
    masked = toxicity.PATTERNS.index("masked")
    seen = [toxicity.patterns_of(t)[masked] for t in ("you f@#k", "s#*t", "f**k", "me@mail.org", "$5 and #1", "")]
    assert seen == [True, True, True, False, False, False]


def test_label_model_discounts_copies():
    """A voter that is copied counts for about one voter, not for many."""
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.2
    fires = lambda hit, false: np.where(truth, rng.random(20_000) < hit, rng.random(20_000) < false)
    copied = fires(0.7, 0.2)
    single = [fires(0.8, 0.05) for _ in range(4)]
    bits = [copied] * 5 + single + [np.zeros(20_000, dtype=bool)] * (toxicity.VOTERS - 9)
    masks = sum(b.astype(np.int64) << i for i, b in enumerate(bits))
    seen, counts = np.unique(masks, return_counts=True)
    known = [(int(m), int(t), 1) for m, t in zip(masks[:500], truth[:500])]
    model = toxicity.fit_label_model(seen, counts.astype(float), known)
    assert model.weights[:5].sum() < 1.6 and model.weights[5:9].min() > 0.6
    assert np.abs(model.fires[5:9, 1] - 0.8).max() < 0.1 and np.abs(model.fires[5:9, 0] - 0.05).max() < 0.05
    guess = model.posterior(toxicity.vote_matrix(masks)) > 0.5
    assert (guess == truth).mean() > 0.93


@given
def test_pipeline(spark):
    """The stages' rows against plain versions, stage by stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, SMALL).collect()
    lettered = lambda text: any(unicodedata.category(c)[0] == "L" for c in text or "")
    assert {r.doc_id for r in kept} == {r.doc_id for r in docs.collect() if lettered(r.text)}

    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    seen = {}
    for r in kept:
        for k in {key(x) for x in r.text.split("\n")}:
            seen[k] = seen.get(k, 0) + 1
    lines = {r.doc_id: "\n".join(x for x in r.text.split("\n") if not key(x) or seen[key(x)] < 10) for r in kept}
    fps = {d: plain_fingerprint(t) for d, t in lines.items()}
    roots = plain_components(set(fps.values()))
    first = {}
    for d in sorted(lines):
        first.setdefault(roots[fps[d]], d)
    lines = {d: lines[d] for d in first.values()}
    exact, sizes = plain_windows((r.text for r in benchmark), 10)

    def leaks(text):
        words = plain_words(text)
        return any(tuple(words[i : i + n]) in exact for n in sizes for i in range(len(words) - n + 1))

    lines = {d: t for d, t in lines.items() if not leaks(t)}
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: [*plain.encode(t, add_special_tokens=False).ids, 0] for d, t in lines.items()}
    got = {}
    for p in sorted(corpus_pipeline.run(spark, SMALL).collect(), key=lambda p: p.start):
        got.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, dtype="<u4").tolist())
    assert got == want


# --- formats ----------------------------------------------------------------------------------------


def test_escapes_are_undone():
    rng = random.Random(4)
    bits = ["<", "|", ">", "\\", "[", "]", "INST", "/", "s>", "end", "\n", "a", "<|", "|>", "<|end|>\n"]
    for _ in range(3000):
        turns = [("".join(rng.choices(bits, k=rng.randint(0, 6))), "".join(rng.choices(bits, k=rng.randint(0, 9)))) for _ in range(3)]
        formatted, spans = chat.render(turns)
        assert chat.read_back(formatted) == turns
        for (_, text), (a, b) in zip(turns, spans):
            assert chat.unescape(formatted[a:b]) == text
            assert not re.search(r"<\||</?s>|\[/?INST\]", formatted[a:b])


@pytest.mark.parametrize("text", ["①", "²½", "Ⅳ ⅷ", "12 + 3", "٣", "..."])
def test_number_characters_are_no_letters(spark, text):
    rows = [(1, "the cat sat on the mat", "en"), (2, "le chat est sur la table", "fr"), (3, text, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc.doc_id: (r.lang_pred, r.score) for r in language_id.predict(frame, language_id.learn(frame)).collect()}
    assert got[3] == ("und", 0.0) and got[1][0] == "en" and got[2][0] == "fr"
    assert language_id.words_of("ab①cd Ⅳe½ É") == ["ab", "cd", "e", "é"]


def test_more_languages_than_a_block(spark, monkeypatch):
    """250 planted languages with words of their own are all learned; blocks agree with one model."""
    rng = random.Random(6)
    syllables = ["".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 3)) for _ in range(500)]
    rows = []
    for n in range(250):
        own = rng.sample(syllables, 12)
        rows += [(n * 8 + i, " ".join("".join(rng.choices(own, k=2)) for _ in range(30)), f"l{n:03}") for i in range(8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").cache()
    taught, asked = frame.where("doc_id % 8 < 6"), frame.where("doc_id % 8 >= 6").unionByName(frame.limit(1).selectExpr("-1L AS doc_id", "'!' AS text", "lang"))
    model = language_id.learn(taught)
    assert len(model.languages) == 200 and [len(m.languages) for m in model.more] == [50]
    got = {r.doc.doc_id: (r.doc.lang, r.lang_pred, r.score) for r in language_id.predict(asked, model).collect()}
    assert got.pop(-1)[1:] == ("und", 0.0) and len(got) == 500
    assert sum(a == b for a, b, _ in got.values()) > 0.95 * len(got)
    few = asked.where("lang < 'l006'")
    some = taught.where("lang < 'l006'")
    whole = {r.doc.doc_id: (r.lang_pred, r.score) for r in language_id.predict(few, language_id.learn(some)).collect()}
    monkeypatch.setattr(language_id, "LANGUAGES", 4)
    split = language_id.learn(some)
    assert [len(m.languages) for m in (split, *split.more)] == [4, 2]
    parts = {r.doc.doc_id: (r.lang_pred, r.score) for r in language_id.predict(few, split).collect()}
    assert {k: v[0] for k, v in parts.items()} == {k: v[0] for k, v in whole.items()}
    assert all(abs(parts[k][1] - whole[k][1]) < 1e-6 for k in whole)


def test_padding_and_garbage_in_archives():
    """Every record is read, or an error names the place."""
    import gzip

    def warc_of(i):
        return f"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\nab{i}\r\n\r\n".encode()

    blocks = lambda data: [b for _, b in warc.warc_records(data)]
    want = [b"ab0", b"ab1", b"ab2"]
    for pad in (b"", b"\0\0", b"\r\n", b"\n\0\r\n" * 40_000):
        assert blocks(b"".join(warc_of(i) + pad for i in range(3))) == want
        assert blocks(b"".join(gzip.compress(warc_of(i)) + pad for i in range(3))) == want
    # line ends of one byte
    assert blocks(warc_of(0).replace(b"\r\n", b"\n") + warc_of(1)) == want[:2]
    packed = [gzip.compress(warc_of(i)) for i in range(3)]
    at = len(packed[0])
    for bad, place in (
        (warc_of(0) + b"junk" + warc_of(1), len(warc_of(0))),
        (packed[0] + b"junk" + packed[1], at),
        (packed[0] + packed[1][:-9], at),
        (packed[0] + packed[1][:12] + b"\xff" * 9 + packed[1][21:], at),
        (warc_of(0) + warc_of(1).replace(b"Content-Length: 3", b"Content-Length: x"), len(warc_of(0))),
        (warc_of(0) + b"WARC/1.1\r\nContent-Length: 3", len(warc_of(0))),
        (warc_of(0)[:-6], 0),
    ):
        with pytest.raises(ValueError, match=rf"\b{place}\b"):
            blocks(bad)


def test_old_heads_and_version_two():
    body = b"<p>x</p>\n\ny"
    for end in (b"\r\n", b"\n"):
        head = b"HTTP/1.0 200 OK" + end + b"X-Record-Key: 7" + end + end
        fields, got, payload = warc.http_parts(head + body)
        assert (fields["x-record-key"], got, payload) == ("7", head, body)
    assert warc.http_parts(b"HTTP/1.0 200 OK\nA: b") == ({"a": "b"}, b"HTTP/1.0 200 OK\nA: b", b"")
    opening = warc.arc_opening(b"2", "x.arc")
    line = opening.split(b"\n", 1)[0].split(b" ")
    assert len(line) == 10 and line[3:5] == [b"text/plain", b"200"] and line[8] == b"x.arc"
    record = warc.arc_header(b"2", "u v", "i", "20200101", "t", 3, **{"Result-code": "404"}) + b"abc\n"
    for pad in (b"", b"\0\0\n"):
        (_, header, block), (_, second, _) = warc.arc_records(opening + record + pad + record + pad)
        assert (header["URL"], header["Result-code"], block, second["URL"]) == ("u v", "404", b"abc", "u v")


def test_archive_errors_are_told():
    good = warc.arc_opening(b"1", "x.arc") + warc.arc_header(b"1", "u", "i", "20200101", "t", 3) + b"abc\n"
    assert [(h["URL"], b) for _, h, b in warc.arc_records(good)] == [("u", b"abc")]
    assert warc.iso_date("20200102") == "2020-01-02T00:00:00Z"
    for bad in (good[:-3], good + b"no header\n", b"3 0 x\n"):
        with pytest.raises(ValueError):
            list(warc.arc_records(bad))


@pytest.mark.parametrize("n", [1, 127, 128, 129, 500])
def test_places_of_many_matches(spark, n):
    """Places are right on either side of the blocks that lengths are added up in."""
    parts = [f"user{i}@mail{i % 7}.org" + "é, " * (i % 5 + 1) for i in range(n)]
    text = "".join(parts)
    row = pii.find_spans(spark.createDataFrame([(text,)], "text string")).first()
    want = [(m.start(), m.end()) for m in re.finditer(r"user\d+@mail\d\.org", text)]
    assert [(s["start"], s["end"]) for s in row.spans] == want and len(want) == n
    totals = spark.range(1).select(pii.running_totals(F.sequence(F.lit(1), F.lit(n))).alias("t")).first().t
    assert totals == [i * (i + 1) // 2 for i in range(n)]


def peak_mb(work):
    """What ``work`` returns, and the most that it held at once."""
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def small_model():
    counts = {"en": {"the": 50, "house": 9, "cat": 9}, "fr": {"le": 50, "maison": 9, "chat": 9}}
    return language_id.fit(counts, {"en": 3, "fr": 3}, [" ", " the", " le", "cat", "ch", "at", "maison", "house"])


def test_language_of_long_texts_in_bounded_memory():
    """The words of long texts aren't held together, and no word beyond the longest is remembered."""
    scorer = language_id.Scorer(small_model())
    short = ["the cat, the house; " * 20, "le chat: la maison! " * 20]
    long = [t * 3000 for t in short] * 4
    (languages, _), most = peak_mb(lambda: scorer.predict(long))
    assert languages == ["en", "fr"] * 4
    assert most < 40
    scorer.predict(["the" * 100_000])
    assert max(map(len, scorer.known)) <= language_id.LONGEST


def test_scores_of_words_in_bounded_memory():
    """Scoring words keeps neither their arcs nor all their positions."""
    model, rng = small_model(), random.Random(8)
    lattice = language_id.Lattice(model.pieces)
    words = ["".join(rng.choices("acehlmostu", k=24)) for _ in range(20_000)]
    probability = np.hstack([model.probability] * 2)
    got, most = peak_mb(lambda: language_id.word_scores(lattice, probability, words))
    assert most < 25
    letters, lengths = lattice.letters(words)
    sums, _ = language_id.forward(lattice, probability, letters, lengths)
    assert np.array_equal(got, np.log(sums[lengths, np.arange(len(words))]))


def test_parts_of_a_text_are_its_words(monkeypatch):
    rng = random.Random(7)
    for part in (1, 7, 50):
        monkeypatch.setattr(language_id, "_PART", part)
        for _ in range(300):
            text = "".join(rng.choices("abÉİΣß①Ⅳ1_'̇­ .中", k=rng.randrange(120)))
            want = [s for w in language_id.words_of(text) for s in language_id._stretches(w)]
            assert [w for words in language_id.parts_of(text) for w in words] == want
    assert list(language_id.parts_of(None)) == list(language_id.parts_of("1 2")) == []


def test_long_texts_in_parts_have_the_same_language(spark, monkeypatch):
    """Cuts change neither what is learned nor what is predicted, and the text need not be kept."""
    rng = random.Random(9)
    rows = []
    for i in range(40):
        own = ("the cat sat on a mat", "le chat dort sur le lit")[i % 2].split()
        rows.append((i, " ".join(rng.choices(own, k=60)) + " " + rng.choice("xyz") * 30, ("en", "fr")[i % 2]))
    docs = spark.createDataFrame([*rows, (40, None, "en"), (41, "", None)], "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(language_id, "fit", lambda *a, fit=language_id.fit: seen.append(a[0]) or fit(*a))
    model = language_id.learn(docs)
    assert max(len(w) for words in seen[0].values() for w in words) <= language_id.LONGEST
    kept, lean = ({r.doc.doc_id: r[1:] for r in language_id.predict(docs, model, keep=k).collect()} for k in (None, ["doc_id"]))
    assert kept == lean and kept[40] == kept[41] == ("und", 0.0)
    assert all(kept[i][0] == lang for i, _, lang in rows)
    whole = language_id.Scorer(model).weigh([t for _, t, _ in rows])
    monkeypatch.setattr(language_id, "_PART", 20)
    monkeypatch.setattr(language_id, "_HELD", 10)
    cut = language_id.Scorer(model).weigh([t for _, t, _ in rows])
    assert cut[0] == whole[0] and np.allclose(cut[1], whole[1]) and np.allclose(cut[2], whole[2])
