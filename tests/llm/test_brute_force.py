"""Operators against plain Python versions, exact round trips and held-out
accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from cohortkit.llm import edit_fingerprint, line_dedup, packing, queries, sharding, simhash, sp_sampling, topk_search, warc

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())


def test_simhash_components(spark, rows):
    want = brute.simhash_components(rows)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op9_simhash(spark, SF).collect()} == want


@pytest.mark.parametrize("cap", [1, 32])
@pytest.mark.parametrize("bits", [1, 2])
def test_simhash_links_find_all_within_the_radius(spark, cap, bits):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(6)]
    codes = {b ^ sum(1 << p for p in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(30)} | {0}
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in codes]
    u = brute.Union()
    for r in simhash.links(spark.createDataFrame(signed, "code long"), bits, cap).collect():
        assert (r["u"] ^ r["v"]).bit_count() <= bits or ((r["u"] ^ r["v"]) & (2**64 - 1)).bit_count() <= bits
        u.link(r["u"] & (2**64 - 1), r["v"] & (2**64 - 1))
    want = brute.Union()
    for a in codes:
        for b in codes:
            if (a ^ b).bit_count() <= bits:
                want.link(a, b)
    group = lambda x: {frozenset(c for c in codes if x.find(c) == x.find(d)) for d in codes}
    assert group(u) == group(want)


@pytest.mark.parametrize("few", [2, 512])
def test_line_dedup_matches_every_pair_compared(spark, few):
    rng = random.Random(few)
    vocab = [f"w{i}" for i in range(60)]
    base = [[rng.choice(vocab) for _ in range(rng.randint(1, 16))] for _ in range(12)]
    rows = []
    for d in range(120):
        lines = []
        for _ in range(rng.randint(0, 3)):
            x = list(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                x[rng.randrange(len(x))] = rng.choice(vocab)
            lines.append(" ".join(x))
        rows.append((d, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["removed"] for r in line_dedup.removed_lines(df, few_entries=few).collect()}
    assert got == brute.line_removals(rows)


def test_line_dedup_candidates_are_handed_on_a_few_at_a_time(spark):
    """A group of alike lines gives the same pairs under each word it shares; a task does
    not hold them until the last one."""
    n, words = 300, 10
    rows = [((w << 32) | (100 << 16) | w, d, d, 0) for w in range(words) for d in range(0, n, w + 1)]
    entries = spark.createDataFrame(rows, "entry long, a long, adoc long, a2 long").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for few in (2, 512):
            got = [(r["a"], r["b"]) for r in line_dedup._candidates(entries, 4, 5, few, most_pairs=1000).where("b is not null").collect()]
            whole = [(r["a"], r["b"]) for r in line_dedup._candidates(entries, 4, 5, few).where("b is not null").collect()]
            assert set(got) == set(whole) and len(set(whole)) == (n * (n - 1) // 2 if few == 512 else n)
        # a pair that stands at other distances under other words leaves more than once
        few_times = line_dedup._candidates(entries, 4, 5, 512, most_pairs=1000).count()
        assert line_dedup._candidates(entries, 4, 5, 512).count() < few_times <= words * n * (n - 1) // 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_line_dedup_has_one_python_worker_a_task(spark, monkeypatch):
    """Workers stay in an executor's memory beside each other, so the texts of the
    candidates are filtered where they are read."""
    plans = []
    keep = line_dedup.stored

    def told(df, name):
        plans.append((name, df._jdf.queryExecution().sparkPlan().toString()))
        return keep(df, name)
    monkeypatch.setattr(line_dedup, "stored", told)
    rows = [(d, f"a b c d e f g h i j{d % 3}\nk l m n o p q r s t{d}") for d in range(30)]
    line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    plan = [p for name, p in plans if name == "line-words"]
    assert plan and all(p.count("MapInArrow") + p.count("ArrowEvalPython") == 1 for p in plan)


def test_line_dedup_tells_rows_without_id_and_of_one_id_apart(spark):
    a, b = "a b c d\nx1 x2 x3 x4", "p q r s\na b c d"
    for i in (None, 7, -2**63):
        df = spark.createDataFrame([(i, a), (i, b)], "doc_id long, text string").repartition(2)
        got = {(r["text"], tuple(r["o"]["removed"]), r["o"]["text"]) for r in line_dedup.dedup_lines(df, out="o").collect()}
        # 'a b c d' stays once, wherever it comes first, and no other line goes
        assert got in ({(a, (), a), (b, (1,), "p q r s")}, {(a, (0,), "x1 x2 x3 x4"), (b, (), b)})
        assert sum(len(r["removed"]) for r in line_dedup.removed_lines(df).collect()) == 1


def test_line_dedup_with_a_third_of_the_ids_missing(spark):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(40)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    rows = [(None if n % 3 == 0 else n // 4, "\n".join(rng.choice(base) for _ in range(rng.randint(0, 4)))) for n in range(150)]
    rows += rows[:20] + [(-2**63, base[0]), (None, None), (None, "")]
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n long, doc_id long, text string").repartition(5)
    got = {r["n"]: r for r in line_dedup.dedup_lines(df, out="o").collect()}
    assert len(got) == len(rows) and all((got[n]["doc_id"], got[n]["text"]) == r for n, r in enumerate(rows))
    # a line keeps one place, its first; blank ones stay
    kept = Counter(frozenset(x.split()) for r in got.values() for x in (r["o"]["text"] or "").split("\n") if x.split())
    want = Counter(frozenset(x.split()) for _, t in rows for x in (t or "").split("\n") if x.split())
    assert all(c == 1 for c in kept.values()) and set(kept) <= set(want)
    near = lambda x, y: 5 * len(x & y) >= 4 * len(x | y)
    assert all(any(near(x, y) for y in kept) or any(near(x, y) for y in set(want) - {x}) for x in want)
    alone = {x for x in want if not any(near(x, y) for y in want if y != x)}
    assert alone <= set(kept)
    first = {}
    for n, (d, t) in sorted(enumerate(rows), key=lambda r: (r[1][0] is not None, r[1][0] or 0)):
        for x in (t or "").split("\n"):
            first.setdefault(frozenset(x.split()), (d is not None, d or 0))
    for n, r in got.items():
        for x in (r["o"]["text"] or "").split("\n"):
            if x.split():
                assert first[frozenset(x.split())] == (r["doc_id"] is not None, r["doc_id"] or 0)


def test_rarity_order_does_not_end():
    n = np.unique(np.concatenate([np.arange(6000), np.geomspace(6000, 2**32 - 1, 2000).astype(np.int64)])).astype(np.uint32)
    code = line_dedup.rarity_codes(n)
    assert (np.diff(code.astype(int)) >= 0).all() and code.max() <= line_dedup.MOST and (code[:1024] == n[:1024]).all()
    far = n[n > 5000].astype(float)
    assert all(a < b for a, b in zip(line_dedup.rarity_codes(far.astype(np.uint32)), line_dedup.rarity_codes(np.minimum(far * 1.02, 2**32 - 1).astype(np.uint32))) if b < line_dedup.MOST - 10)


def test_minimax_search():
    rng = random.Random(1)
    for n, hi, shards in ((5, 10, 3), (1, 10, 16), (400, 1000, 16), (3000, 9, 16)):
        for lumps in (False, True):
            sizes = [int(rng.paretovariate(1.1)) + 1 if lumps else rng.randint(1, hi) for _ in range(n)]
            ends = np.cumsum(sizes)

            def fetch(gaps):
                cells = {}
                for k, (p, q, step) in enumerate(gaps):
                    for e in ends[(ends > p) & (ends <= q)].tolist():
                        low, high, m = cells.get((k, (e - p - 1) // step), (e, e, 0))
                        cells[k, (e - p - 1) // step] = (min(low, e), max(high, e), m + 1)
                return list(cells.values())

            cut = sharding._search(fetch, int(ends[-1]), max(sizes), shards)
            assert max(np.diff([0, *cut])) == brute.minimax(sizes, shards)


def test_shards(spark, rows):
    text = dict(rows)
    got = queries.op5_minimax_sharding(spark, SF).collect()
    where, slots = defaultdict(set), defaultdict(list)
    for r in got:
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        where[text[r["doc_id"]]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert len(got) == len(rows) and all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))


def test_packing(spark, rows):
    from public_tokenizers import path
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    got = queries.op3_vector_packing(spark, SF).collect()
    by, seq = defaultdict(list), defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, x in rows:
        ids, at = t.encode(x or "", add_special_tokens=False).ids + [2], 0
        for i, r in enumerate(sorted(by[d], key=lambda r: r["piece"])):
            n = r["length"]
            assert (r["piece"], r["start"], r["ids_crc32"]) == (i, at, zlib.crc32(np.array(ids[at:at + n], "<u4").tobytes()))
            assert i == 0 or n == 1024
            at += n
        assert at == len(ids)
    for s in seq.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 1024
    assert len(seq) <= 1.02 * math.ceil(sum(r["length"] for r in got) / 1024) + 1


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(score):
    n = np.random.default_rng(0).integers(1, 101, 500)
    bins, offs = packing.vector_best_fit(n, 100, 4, 6000.0, score)
    for b in set(bins.tolist()):
        own = n[bins == b]
        assert own.sum() <= 100 and len(own) <= 4 and (len(own) == 1 or (own.astype(float) ** 2).sum() <= 6000)


def test_sampling_without_replacement_has_the_exact_distribution():
    v = sp_sampling.vocabulary(sp_sampling.default_model(), 0.3, "rank")
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=sp_sampling.default_model())
    ids = {sp.id_to_piece(i): i for i in range(sp.vocab_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    text, found = "▁the▁cat", {}

    def walk(at, got, w):
        if at == len(text):
            found[tuple(got)] = w
        for k in range(1, len(text) - at + 1):
            if text[at:at + k] in ids:
                walk(at + k, [*got, ids[text[at:at + k]]], w + v.weight[ids[text[at:at + k]]])
    walk(0, [], 0.0)
    z = math.log(sum(math.exp(w) for w in found.values()))
    p = {a: math.exp(w - z) for a, w in found.items()}
    n, one, two = 8000, Counter(), Counter()
    for a, b in sp_sampling.sample_batch(v, ["the cat"] * n, list(range(n)), 2):
        x, y = tuple(a[0].tolist()), tuple(b[0].tolist())
        assert x != y and abs(a[1] - math.log(p[x])) < 1e-6 and a[2] > b[2] and a[3] <= 0
        one[x] += 1
        two[x, y] += 1
    top = sorted(p, key=p.get)[-6:]
    for a in top:
        assert abs(one[a] / n - p[a]) < 5 * math.sqrt(p[a] / n) + 1e-3
        for b in top:
            if a != b:
                q = p[a] * p[b] / (1 - p[a])
                assert abs(two[a, b] / n - q) < 5 * math.sqrt(q / n) + 1e-3


def test_all_segmentations_of_a_short_text_and_round_trip():
    v = sp_sampling.vocabulary(sp_sampling.default_model(), 1.0, "rank")
    got = sp_sampling.sample_batch(v, ["the"], [1], 50)[0]
    assert len({tuple(g[0].tolist()) for g in got}) == len(got) < 50 and all(g[3] == 0.0 for g in got)
    texts = ["", " ", "  a  b ", "x\ty\n\nz", "中文 \U0001F600\x00", "èé" * 300, "word" * 5000]
    for t, r in zip(texts, sp_sampling.sample_batch(v, texts, range(len(texts)), 2)):
        assert all(v.decode(g[0]) == t for g in r)


def test_edit_fingerprints(spark, rows):
    import hashlib
    got = {r["doc_id"]: r for r in queries.op7_edit_fingerprints(spark, SF).collect()}
    near, far = [], []
    for i, (d, t) in enumerate(rows):
        after, cut = rows[(i + 1) % len(rows)][1] or "", len(t or "") // 4
        edited = (t or "")[:len(t or "") - cut] + after[:cut]
        assert got[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        c = edit_fingerprint.char_classes(edited)
        bits = edit_fingerprint.sample_bits(c, edit_fingerprint.arrivals(c))
        assert got[d]["edited_fingerprint"] == edit_fingerprint.to_hex(bits)
        near.append(got[d]["near_edited"])
        far.append(got[d]["near_next"])
    assert np.mean(near) > 0.7 and np.median(far) < 0.3


def test_edit_near_classes(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    rows = []
    for g in range(5):
        w = [word() for _ in range(200)]
        for k in range(6):
            x = list(w)
            x[rng.randrange(200)] = word()
            rows.append((10 * g + k, " ".join(x)))
    fp = edit_fingerprint.edit_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), parts=3).select("doc_id", "fingerprint")
    for block in (2, 1024):
        got = {r["doc_id"]: r["class_id"] for r in edit_fingerprint.near_classes(fp, 0.7, block=block).collect()}
        assert got == {d: d // 10 * 10 for d, _ in rows}


def test_top_k(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(700, 70))
    v[300:330] = v[5]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    codes = topk_search.sign_codes(df, 70)
    got = defaultdict(list)
    for r in topk_search.hamming_top_k(codes, codes.where("id % 20 = 0"), 70, 7, index_block=20).collect():
        got[r["query_id"]].append((r["rank"], r["distance"], r["id"]))
    b = v >= 0
    for q in range(0, 700, 20):
        d = (b != b[q]).sum(axis=1)
        want = sorted(zip(d.tolist(), range(700)))[:7]
        assert [(x, i) for _, x, i in sorted(got[q])] == want


def test_warc(spark):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    want = brute.warc_rows(pages)
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in queries.op8_warc(spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("version", ["1", "2"])
def test_arc_versions(spark, tmp_path, version):
    rows = [(f"http://h/{i}", "1.2.3.4", f"2024010100{i:04d}", "text/html", bytes([i % 256]) * i + b"\n\nhttp://x 1.1.1.1 20200101000000 text/html 3\nabc") for i in range(50)]
    df = spark.createDataFrame(rows, "url string, ip string, date string, content_type string, payload binary").coalesce(2)
    warc.write_arc(df, str(tmp_path / version), version, file_rows=7)
    got = {r["url"]: (r["version"], r["ip"], r["date"], bytes(r["payload"])) for r in warc.read_arc(spark, str(tmp_path / version)).collect()}
    assert got == {u: (version, ip, d, p) for u, ip, d, _, p in rows}
    assert warc.warc_date("20240229123456") == "2024-02-29T12:34:56Z" and warc.warc_date("1996") == "1996-01-01T00:00:00Z"


def test_held_out_quality_and_language(spark):
    sf = "/root/testdata/sf0.01"
    lab = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [(lab[r["doc_id"]], r["predicted"]) for r in queries.op2_quality_fm(spark, sf).collect() if r["held_out"] and r["doc_id"] in lab]
    assert len(got) > 30 and np.mean([a == b for a, b in got]) > 0.9
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    told = [(lang[r["doc_id"]], r["lang_pred"]) for r in queries.op10_langid(spark, sf).collect() if r["held_out"]]
    assert len(told) > 100 and np.mean([a == b for a, b in told]) > 0.97


def test_pipeline_against_plain_python(spark):
    """Every stage of the whole pipeline by its plain version (the two models
    are the fitted ones)."""
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in P.STAGES[:2]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
    kept = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    gone = brute.line_removals(kept)
    kept = [(d, brute.kept_text(t, gone.get(d))) for d, t in kept if d not in gone or brute.kept_text(t, gone[d]).split()]
    root = brute.simhash_components(kept)
    kept = {d: t for d, t in kept if root[d][1] == d}
    got = P.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == set(kept)
    enc = packing._encoder(*packing.default_tokenizer()[:2])
    for r in got:
        if r["piece"] == 0 and r["length"] < 1024:
            ids = np.array(enc.encode_ordinary(kept[r["doc_id"]]) + [2], "<u4")[:r["length"]]
            assert r["ids_crc32"] == zlib.crc32(ids.tobytes())


def test_tokenizer_twin():
    from hypothesis import given, settings, strategies as st
    from public_tokenizers import path
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    enc = packing._encoder(*packing.default_tokenizer()[:2])

    @settings(max_examples=200, deadline=None)
    @given(st.text())
    def same(x):
        assert t.encode(x, add_special_tokens=False).ids == packing.token_ids(enc, x)
    same()
    assert t.encode("<|endoftext|>", add_special_tokens=False).ids == packing.token_ids(enc, "<|endoftext|>") == [50256]


def test_added_token_in_texts(docs_of):
    """Ids as the tokenizers file gives them when called plainly."""
    from hypothesis import given, settings, strategies as st
    from public_tokenizers import path
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    enc = packing._encoder(*packing.default_tokenizer()[:2])
    assert packing.token_ids(enc, "a<|endoftext|>b") == t.encode("a<|endoftext|>b", add_special_tokens=False).ids == [64, 50256, 65]

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.one_of(st.text(), st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "\n"]))))
    def same(x):
        x = "".join(x)
        assert packing.token_ids(enc, x) == t.encode(x, add_special_tokens=False).ids
    same()
    rows = [(1, "a<|endoftext|>b"), (2, "a  <|endoftext|>  b" * 40), (3, "<|endoftext|>"), (4, None)]
    got = {(r["doc_id"], r["start"]): (r["length"], r["ids_crc32"]) for r in packing.pack_documents(docs_of(rows), 64).collect()}
    for d, x in rows:
        ids, at = t.encode(x or "", add_special_tokens=False).ids + [2], 0
        for n in packing.piece_lengths(len(ids), 64):
            assert got.pop((d, at)) == (n, zlib.crc32(np.array(ids[at:at + n], "<u4").tobytes()))
            at += n
    assert not got
