"""Corpus operators against brute force, and on odd rows: NULLs, empty and long texts, repeats, clashing columns."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from callsight.llm import kdsearch, licenses, merkle, packing, repeats, sharding, simhash, toxicity, urlfilter

SCHEMA = "doc_id long, text string, row string, fp string, kept string, spans string, score string, g string"
PASSAGE = "a passage of more than fifty bytes that several documents share word for word"


def odd_rows():
    words = [f"w{i * 7919 % 997}" for i in range(4000)]
    texts = [None, "", " \n ", "short", PASSAGE, f"start {PASSAGE} end", f"ñandú {PASSAGE}", " ".join(words), " ".join(words),
             " ".join(words[:3999]) + " other", "x" * 3000, "y" + "x" * 2000, "Released under the MIT License.",
             "Apache License, Version 2.0. the mit license the MIT license", "CC BY-NC 4.0 <|endoftext|> tail"]
    return [(i, t, "r", "f", "k", "s", "c", "g") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_sharding_counts_slots_and_repeats(spark, odd, none):
    keys = sharding.document_keys(odd.unionAll(odd))
    got = sharding.shard(spark, keys, 4).toPandas()
    sizes = got.groupby("shard").slot.agg(["count", "nunique", "min", "max"])
    assert len(got) == 30 and set(sizes["count"]) == {7, 8}
    assert (sizes["nunique"] == sizes["count"]).all() and (sizes["max"] == sizes["count"] - 1).all()
    text = {i: (r[1] or "").encode() for i, r in enumerate(odd_rows())}
    assert all((r.size_, r.text_crc32) == (len(text[r.doc_id]) + 8, zlib.crc32(text[r.doc_id]))
               for r in got.rename(columns={"size": "size_"}).itertuples())
    assert sharding.shard(spark, sharding.document_keys(none), 4).count() == 0


def test_place_prefers_home_and_fills_exactly():
    counts, owners = [5, 0, 9, 1, 3], [0, 1, 0, 2, 1]
    pieces = sharding.place(counts, owners, 3)
    taken = [0, 0, 0]
    for c, own in zip(counts, pieces):
        ends = [p[0] for p in own[1:]] + [c]
        for (lo, s, slot), hi in zip(own, ends):
            assert slot == taken[s] or slot < taken[s] + hi - lo + 18
            taken[s] += hi - lo
    assert taken == [6, 6, 6] and pieces[0][0][1] == 0


def removed(rows, size=50):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - size + 1):
            first[b[i:i + size]] = min(first.get(b[i:i + size], d), d)
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - size + 1):
            if first[b[i:i + size]] < d:
                gone[i:i + size] = True
        out[d] = (np.frombuffer(b, np.uint8)[~gone].tobytes(), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()))
    return out


@pytest.mark.parametrize("batch", [8 << 20, 2000])
def test_repeats_equal_brute_force(odd, none, batch):
    got = {r.row.doc_id: (bytes(r.kept), len(r.spans)) for r in
           repeats.remove_repeats(odd, batch_bytes=batch, bucket_bytes=batch).collect()}
    assert got == removed([(r[0], r[1]) for r in odd_rows()])
    assert repeats.remove_repeats(none).count() == 0


@pytest.mark.parametrize("dense", [0, 2, 100000])
def test_repeats_of_dense_anchors(spark, dense):
    rng = np.random.default_rng(5)
    line, other = "a line of thirty-nine bytes, very common", PASSAGE
    rows = []
    for i in range(60):
        own = "".join(rng.choice(list("abcd "), 40))
        rows.append((i, f"{own[:20]}{line}{own[20:]}{line}" + (other if i % 7 == 0 else "") + own[i % 3:i % 3 + 8] * (i % 5)))
    rows += [(60 + i, rows[i][1][i:]) for i in range(0, 30, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.row.doc_id: (bytes(r.kept), len(r.spans)) for r in
           repeats.remove_repeats(df, batch_bytes=900, bucket_bytes=1500, dense=dense).collect()}
    assert got == removed(rows)


def test_repeats_null_and_shared_ids(spark):
    df = spark.createDataFrame([(None, PASSAGE), (3, PASSAGE), (3, PASSAGE), (5, PASSAGE)], "doc_id long, text string")
    got = sorted((r.row.doc_id or -1, len(r.kept)) for r in repeats.remove_repeats(df).collect())
    assert got == [(-1, len(PASSAGE)), (3, len(PASSAGE)), (3, len(PASSAGE)), (5, 0)]


def plain_fingerprint(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash_equals_brute_force(odd, none):
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(odd.unionAll(odd)).collect()}
    fps = {r[0]: plain_fingerprint(r[1]) for r in odd_rows()}
    comp = dict(zip(fps, fps))
    for _ in fps:
        for a in fps:
            comp[a] = min(comp[b] for b in fps if (fps[a] ^ fps[b]).bit_count() <= 3)
    assert got == {d: (fps[d], comp[d]) for d in fps}
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("dense", [4096, 20])
def test_simhash_links_of_dense_cells(spark, dense):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = {int(b) ^ int(sum(1 << int(x) for x in set(rng.integers(0, 64, k)))) for b in base for k in (0, 1, 1, 2, 2, 3, 5, 9)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in sorted(fps)]
    links = simhash.fingerprint_links(spark.createDataFrame(signed, "fp long"), max_bits=3, dense=dense).collect()
    from callsight.llm.components import connected_components
    got = {r.node: r.root for r in connected_components(spark.createDataFrame([(r.a, r.b) for r in links], "a long, b long")).collect()}
    ids = [x for x, in signed]
    comp = {x: x for x in ids}
    for _ in range(12):
        for a in ids:
            comp[a] = min(comp[b] for b in ids if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3)
    assert {x: got.get(x, x) for x in ids} == comp


def test_toxicity_holds_out_and_scores_everything(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.train(docs, labels, docs)
    held = docs.join(labels, "doc_id").where(toxicity.fold() == 0)
    p = toxicity.score(held, model, keep=["doc_id", "toxic"]).select("row.toxic", "score").toPandas()
    rank, n1 = p.score.rank(), int(p.toxic.sum())
    assert (rank[p.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(p) - n1)) > 0.85
    got = [r.score for r in toxicity.score(odd, model).collect()]
    assert len(got) == 15 and all(0 <= s <= 1 for s in got)
    assert toxicity.train(none, labels.limit(0), none) is None
    assert [r.score for r in toxicity.score(odd.limit(1), None).collect()] == [0.0]


def plain_kneser_ney(rows, corpus):
    """p(w|u) per class over plain dictionaries; words outside the sample are None."""
    words = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
    n, right, left, total = ({0: {}, 1: {}} for _ in range(4))
    for text, c in rows:
        w = words(text)
        for u, x in zip(["<"] + w, w):
            n[c][u, x] = n[c].get((u, x), 0) + 1
            total[c][u] = total[c].get(u, 0) + 1
            right[c].setdefault(u, set()).add(x)
            left[c].setdefault(x, set()).add(u)
    vocab = {x for c in (0, 1) for x in left[c]} | {None}
    shared = {}
    for text in corpus:
        w = words(text)
        for u, x in zip(["<"] + w, w):
            if x in vocab:
                shared.setdefault(x, set()).add(u)
    s = {x: len(shared.get(x, ())) for x in vocab}
    d, weight, pair, v = toxicity.DISCOUNT, toxicity.WORD_WEIGHT, toxicity.PAIR_WEIGHT, len(vocab)
    r = {x: (s[x] + 1) / (sum(s.values()) + v) for x in vocab}
    k = {c: {x: len(left[c].get(x, ())) for x in vocab} for c in (0, 1)}
    base = weight * v / (weight * v + (sum(k[0].values()) + sum(k[1].values())) / 2)
    q = {c: {x: (1 - base) * (max(k[c][x] - d, 0) + d * sum(y > 0 for y in k[c].values()) * r[x]) / sum(k[c].values()) + base / v
             for x in vocab} for c in (0, 1)}

    def p(c, u, x):
        t = len(right[c].get(u, ()))
        return (max(n[c].get((u, x), 0) - d, 0) + (pair * v + d * t) * q[c][x]) / (total[c].get(u, 0) + pair * v)

    return words, vocab, p


def test_toxicity_equals_a_dictionary_implementation(spark):
    rng = np.random.default_rng(7)
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 > 1][:40]           # nothing to fit the curve on
    vocabulary = [f"w{i}" for i in range(30)] + ["Ñandú", "Loser"]
    rows = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 20))) + (" you loser" if j % 2 else "!"), j % 2) for j, i in enumerate(ids)]
    more = [(1000 + i, " ".join(rng.choice(vocabulary + ["new", "other"], 15)), None) for i in range(40)] + [(2000, None, None), (2001, "", None)]
    df = spark.createDataFrame(rows + more, "doc_id long, text string, toxic int").repartition(3)
    model = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"), df)
    words, vocab, p = plain_kneser_ney([(t, c) for _, t, c in rows], [t for _, t, _ in rows + more])
    for c in (0, 1):
        for u in ("<", "w3", "you", "unheard"):
            assert abs(sum(p(c, u, x) for x in vocab) - 1) < 1e-9
    texts = [t for _, t, _ in rows[:10] + more] + ["you LOSER unheard w3 w3", "unheard of"]
    got = model.evidence(pa.array([(t or "").encode() for t in texts], pa.binary()))
    for (mean, best), t in zip(got, texts):
        w = [x if x in vocab else None for x in words(t)]
        x = [np.log(p(1, u, b) / p(0, u, b)) for u, b in zip(["<"] + w, w)]
        assert abs(mean - (np.mean(x) if x else 0)) < 1e-5 and abs(best - (max(x) if x else 0)) < 1e-5
    counts = toxicity.shared_contexts(df, model.vocab)
    pairs = {(u, x) for _, t, _ in rows + more for w in [words(t)] for u, x in zip(["<"] + w, w) if x in vocab}
    assert counts.sum() == len(pairs) and counts[0] == 0


def test_toxicity_places():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000):
        held = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        asked = np.concatenate([held, rng.integers(0, 1 << 64, 500, dtype=np.uint64), held[:1] + np.uint64(1)])
        where = {int(h): i for i, h in enumerate(held)}
        assert toxicity.Places(held).find(asked).tolist() == [where.get(int(h), -1) for h in asked]


def test_toxicity_packed_keys():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 5000, dtype=np.uint64))
    assert (toxicity._unpacked(toxicity._packed(keys)) == keys).all() and len(toxicity._unpacked(toxicity._packed(keys[:0]))) == 0


def test_toxicity_rare_words_and_pairs_give_graded_evidence(spark):
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 > 0][:400]
    rows, left = [], 7                            # seven toxic learning documents hold a word and a pair that no other has
    for k, i in enumerate(ids):
        few = int(k % 2 == 1 and left > 0 and zlib.crc32(str(i).encode()) % 5 > 1)
        left -= few
        rows.append((i, f"a{k % 7} red b{left if few else k % 5}{' zorg' * few} moon c{k % 3}{' red moon' * few}", k % 2))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"), df)
    plain, word, pair, new = model.evidence(pa.array([b"red b1 moon", b"red zorg moon", b"red moon", b"unheard"]))[:, 1]
    assert word > max(plain, new) + 0.5 and pair > plain + 0.1 and abs(new) < 0.3, (plain, word, pair, new)
    held = {w for _, t, _ in rows for w in t.split()}
    assert len(model.vocab) == len(held)


def test_toxicity_few_labels_keep_clean_documents(spark):
    by = {f: [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == f] for f in range(5)}
    # toxic ids: none in the tuning fold, all in it, one alone
    for toxic in (by[2][:1] + by[3][:1] + by[4][:1], by[1][:3], by[3][:1]):
        rows = [(i, "vile hateful slur filth" if i in toxic else f"a calm text number n{i % 9} of the day", int(i in toxic))
                for f in by for i in by[f][:12]] + [(1000, None, None), (1001, "something new", None)]
        df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
        model = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"), df)
        got = {r.doc_id: r.score for r in toxicity.score(df, model).select("row.doc_id", "score").collect()}
        assert all(got[i] < 0.5 for i, _, y in rows if not y) and len(got) == len(rows)
        assert min(got[i] for i in toxic) > max(got[i] for i, _, y in rows if not y)
    # toxic labels on texts without words: no model
    rows = [(i, "" if i in by[2] else "a calm text", int(i in by[2])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"), df) is None


def test_licenses_equal_brute_force(odd, none):
    got = {r.row.doc_id: r for r in licenses.scan(odd).collect()}
    for d, t, *_ in odd_rows():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
        at = [(i, label) for phrase, label in licenses.BASE for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
        r = got[d]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(at), ",".join(sorted({x for _, x in at})))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert licenses.scan(none).count() == 0


def test_license_base_phrases_are_whole(spark):
    texts = ["released Under the MIT License", "the MIT license", "under the mit license, under THE mit-license; cc by NC",
             "Apache License, Version 2.0 and apache license 2", "under the mit", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.row.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(df).collect()}
    assert got == {0: (5, 1, 1, 1, "mit"), 1: (3, 0, None, None, ""), 2: (11, 3, 0, 8, "cc-by-nc,mit"),
                   3: (9, 1, 0, 0, "apache-2"), 4: (3, 0, None, None, ""), 5: (0, 0, None, None, "")}


def test_license_notice_needs_its_key_phrase(spark):
    text = licenses.NOTICES[2][1]
    df = spark.createDataFrame([(1, "x " + text), (2, text.replace("source", "sauce"))], "doc_id long, text string")
    assert {r.row.doc_id: r.labels for r in licenses.scan(df).collect()} == {1: "bsd", 2: ""}


def test_packing_ids_pieces_and_bound(odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack_documents(odd.unionAll(odd), capacity=512).toPandas()
    got["doc_id"] = [r["doc_id"] for r in got["row"]]
    for d, t, *_ in odd_rows():
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        mine = got[got.doc_id == d]
        assert mine.length.sum() == 2 * len(ids)
        assert all(zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == p.ids_crc32 for p in mine.itertuples())
        assert all(p.length == 512 for p in mine.itertuples() if p.piece > 0)
    s = got.sort_values(["sequence_id", "offset"])
    assert (s.groupby("sequence_id").length.cumsum() - s.length == s.offset).all()
    assert s.groupby("sequence_id").length.sum().max() <= 512
    assert packing.pack_documents(none).count() == 0


def test_packing_very_long_white_space(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a" + c * 1000000 + "b" for c in ("\n", " ")] + ["c \t" * 20]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = packing.pack_documents(df).toPandas()
    got["doc_id"] = [r["doc_id"] for r in got["row"]]
    for d, t in enumerate(texts):
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [0], "<u4")
        mine = got[got.doc_id == d]
        assert mine.length.sum() == len(ids)
        assert all(zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == p.ids_crc32 for p in mine.itertuples())


def test_bound_and_best_fit():
    rng = np.random.default_rng(2)
    for _ in range(30):
        sizes = rng.integers(1, 100, rng.integers(1, 60))
        bins, offsets, free = packing.best_fit(sizes, 100)
        assert packing.lower_bound(sizes, 100) <= len(free)
        assert all(sizes[bins == b].sum() + free[b] == 100 for b in range(len(free)))
    assert packing.lower_bound(np.array([51, 51, 51]), 100) == 3


def test_packing_exchanges_between_partitions(spark):
    sizes = np.random.default_rng(3).integers(1, 2048, 5000)
    items = spark.createDataFrame([(i, int(s)) for i, s in enumerate(sizes)], "uid long, length long")
    got = packing.pack(items, per_partition=500).toPandas()
    assert got.uid.nunique() == len(got) == 5000
    alone = sum(len(packing.best_fit(sizes[i::10], 2048)[2]) for i in range(10))
    whole = len(packing.best_fit(sizes, 2048)[2])
    assert packing.lower_bound(sizes, 2048) <= got.sequence_id.nunique() < alone
    # what the exchange wins back of the loss against one partition
    assert got.sequence_id.nunique() - whole <= (alone - whole) / 2, (alone, whole)


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    v = np.round(rng.normal(size=(400, 6)), 1)
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(400, None), (401, [1.0, None] * 3), (402, [float("nan")] * 6),
                                                                   (None, [1.0] * 6), (403, [])]
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    got = {}
    for r in kdsearch.top_k(df, F.col("id") % 50 == 0, rows_per_shard=90, leaf=8).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    w = np.floor(256 * v.astype(np.float32).astype(float)).astype(int)
    assert got == {q: sorted((-int(w[q] @ w[i]), i) for i in range(400) if i != q)[:5] for q in range(0, 400, 50)}
    few = kdsearch.top_k(df.where("id < 3"), F.col("id") == 0).collect()
    assert len(few) == 2 and kdsearch.top_k(df.limit(0), F.col("id") == 0).count() == 0


def test_url_rules(spark):
    urls = ["https://a.org/x", "http://org", "https://EXAMPLE.org/es/1?q", "https://m.example.org/en/12", "x://b.com/fr/",
            "x://b.com/de/5#a", "x://borg/", None, "no scheme", "x://a.net/p://q", "x://example.org/e"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(df).collect()}
    assert [got[i][:3] for i in range(11)] == [
        ("a.org", "/x", "org/"), ("org", "", None), ("example.org", "/es/1", "example.org/es/"),
        ("m.example.org", "/en/12", "example.org/en/1"), ("b.com", "/fr/", "com/fr/"), ("b.com", "/de/5", "com/de/"),
        ("borg", "/", None), ("", "", None), ("", "", None), ("a.net", "/p://q", None), ("example.org", "/e", "org/")]
    assert [got[i][3] for i in (0, 2, 3, 4, 5)] == ["allow", "block", "block", "allow", "block"]
    assert {v[3] for v in got.values()} <= {"allow", "block"} and urlfilter.judge(df.limit(0)).count() == 0


def test_urls_copies_and_rare_suffixes(spark):
    urls = [f"x://a.org/{'p' * k}" for k in (1, 2, 3)] * 50 + [f"x://b.com/de/{'9' * k}?a=1&b=2" for k in (21, 22, 23)] * 50
    new = ["x://c.net/pp", "x://c.net/de/9999999999999999999999?a=1&b=2"]
    df = spark.createDataFrame(list(enumerate(urls + new)), "page_id long, url string")
    got = {r.page_id: r for r in urlfilter.judge(df, train_rows=5).collect()}
    assert len(got) == 302 and [got[i].verdict for i in (300, 301)] == ["allow", "block"]
    many = spark.createDataFrame([(i, f"x://h.s{i % 1100}/{i}") for i in range(2200)], "page_id long, url string")
    judged = urlfilter.judge(many)
    assert judged.count() == 2200 and judged.select("page_id").distinct().count() == 2200
    shares = urlfilter.with_suffix_share(urlfilter.with_parts(many)).collect()
    assert len(shares) == 2200 and all(abs(r.suffix_share - 2 / 2200) < 1e-12 for r in shares)


def test_merkle_neighbours_and_likeness(odd, none):
    got = {r.doc_id: r for r in merkle.with_following(odd, rows_per_bucket=2).collect()}
    texts = [r[1] or "" for r in odd_rows()]
    assert len(got) == 15 and all(got[i].following == texts[(i + 1) % 15] for i in range(15))
    pairs = odd.select("doc_id", "text", F.concat(F.coalesce("text", F.lit("")), F.lit("!")).alias("edited"),
                       F.col("text").alias("following"))
    out = {r.doc_id: r for r in merkle.fingerprints(pairs).collect()}
    assert all(r.near_next == 1.0 and 0 <= r.near_edited < 1 and r.fingerprint != r.edited_fingerprint for r in out.values())
    assert out[7].fingerprint == out[8].fingerprint != out[9].fingerprint and out[7].near_edited > 0.99
    assert merkle.with_following(none).count() == 0


def test_op10_edit(spark, tmp_path):
    texts = ["abcdefgh", None, "ñandú está aquí", "x"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in merkle.op10_fingerprints(spark, str(tmp_path)).collect()}
    t = [x or "" for x in texts]
    for i, x in enumerate(t):
        q = len(x) // 4
        edited = x[:len(x) - q] + t[(i + 1) % 4][:q]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(x), hashlib.sha256(edited.encode()).hexdigest())


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as cp
    rows = [(r[0], r[1], "en", "s", 0) for r in odd_rows()] + [(None, PASSAGE, None, None, None), (99, f"é{PASSAGE}é", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    near = cp.near_duplicate_documents(spark, docs, "")
    fps = {r[0]: plain_fingerprint(r[1]) for r in rows if r[0] is not None}
    ids = {r.doc_id for r in near.collect()}
    assert near.columns == cp.COLUMNS and None in ids and 7 in ids and 8 not in ids
    assert len({fps[d] for d in ids if d is not None}) == len(ids) - 1
    cut = cp.repeated_passages(spark, docs, "")
    got = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == cp.COLUMNS and got[0].text is None and got[99].text == "éé" and got[8].text == ""
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.values())


def test_sentencepieces_viterbi_and_round_trip(odd, none):
    from callsight.llm import sentencepieces
    got = {r.row.doc_id: r for r in sentencepieces.encode(odd).collect()}
    assert all(r.round_trip for r in got.values()) and got[0].ids == [] == got[1].ids
    codec = sentencepieces.Codec()
    known = {p: codec.score[i] for i, p in enumerate(codec.pieces) if i not in codec.byte_of and i > 2}

    def best(w):           # every way to cut the word
        if not w:
            return 0.0
        cuts = [known[w[:k]] + best(w[k:]) for k in range(1, len(w) + 1) if w[:k] in known]
        size = len(w.decode()[0].encode())
        return max(cuts + [codec.low * size + best(w[size:])])

    for word in ("the", "hello", "ñandú", "\U0001f600a", "zqxj"):
        w = ("\u2581" + word).encode()
        total = sum(codec.low if i in codec.byte_of else codec.score[i] for i in codec.word(w))
        assert abs(total - best(w)) < 1e-6
    for text in (" a  b ", "x\u2581y", "\n\t", " "):
        assert codec.decode(codec.encode(text)) == text
    assert sentencepieces.encode(none).count() == 0


def test_sentencepieces_runs_of_blanks_as_unsplit_viterbi():
    from callsight.llm import sentencepieces
    codec = sentencepieces.Codec()
    known = {p: i for i, p in enumerate(codec.pieces) if i not in codec.byte_of and i > 2}
    assert not any("\u2581" in p.decode().lstrip("\u2581") for p in known)
    longest = max(map(len, known))

    def whole(text):       # the whole text at once; ties: the longest last piece
        w = (" " + text).replace(" ", "\u2581").encode()
        best, how = [0.0] + [None] * len(w), [None] * (len(w) + 1)
        for e in range(1, len(w) + 1):
            for k in range(max(0, e - longest), e):
                if best[k] is None:
                    continue
                ways = [(best[k] + codec.score[known[w[k:e]]], [known[w[k:e]]])] if w[k:e] in known else []
                if (w[k] & 0xC0) != 0x80 and (e == len(w) or (w[e] & 0xC0) != 0x80) and len(w[k:e].decode()) == 1:
                    ways.append((best[k] + codec.low * (e - k), [codec.byte_ids[b] for b in w[k:e]]))
                for x, ids in ways:
                    if best[e] is None or x > best[e]:
                        best[e], how[e] = x, (k, ids)
        out, e = [], len(w)
        while e:
            e, ids = how[e]
            out = ids + out
        return out

    for text in ("def f(x):\n    if x:\n        return  x", "a" + " " * 40 + "b", "   ", " a  b ", "| col   | \u00f1and\u00fa |\t  end  ",
                 "plain words only", "  \U0001f600   \n   "):
        ids = codec.encode(text)
        assert ids == whole(text) and codec.decode(ids) == text
    assert len(codec.encode(" " * 15 + "x")) < 15


def test_characters_cut_in_part_go_and_others_stay():
    import corpus_pipeline as cp
    text = "a\ufffdé€\U0001f600ñ\ufffdz"
    b = text.encode()
    starts = [len(text[:i].encode()) for i in range(len(text) + 1)]
    for lo in range(len(b) + 1):
        for hi in range(lo + 1, len(b) + 1):
            whole = "".join(c for i, c in enumerate(text) if starts[i + 1] <= lo or starts[i] >= hi)
            assert cp.whole_characters(b[:lo] + b[hi:], [lo]).decode() == whole
            for end in range(hi + 1, len(b)):
                kept = b[:lo] + b[hi:end] + b[end + 1:]
                two = "".join(c for i, c in enumerate(text) if (starts[i + 1] <= lo or starts[i] >= hi)
                              and (starts[i + 1] <= end or starts[i] > end))
                assert cp.whole_characters(kept, [lo, lo + end - hi]).decode() == two


def test_pipeline_keeps_shared_ids_and_replacement_characters(spark):
    import corpus_pipeline as cp
    other = "another text with words of its own that nobody else has written down anywhere at all"
    rows = [(1, f"\ufffd{PASSAGE}", "en", "s", 1), (1, other, "en", "s", 1), (1, other, "en", "s", 1), (2, other, "en", "s", 1),
            (3, f"é{PASSAGE}\ufffdé", "en", "s", 1), (None, other, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    near = sorted((r.doc_id or 0, r.text) for r in cp.near_duplicate_documents(spark, docs, "").collect())
    assert near == [(0, other), (1, other), (1, f"\ufffd{PASSAGE}"), (3, f"é{PASSAGE}\ufffdé")]
    cut = {(r.doc_id, r.text) for r in cp.repeated_passages(spark, docs.where("doc_id <> 2"), "").collect()}
    assert (3, "é\ufffdé") in cut and (1, f"\ufffd{PASSAGE}") in cut


def python_chains(df) -> list[str]:
    """Python functions that run in one task above another one: no exchange stands between them."""
    above, found = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        name = re.search(r"[A-Za-z]\w*", line)
        if name is None:
            continue
        above = [(d, n) for d, n in above if d < name.start()]
        since = []
        for _, n in reversed(above):
            if "Exchange" in n:
                break
            since.append(n)
        if re.search("Arrow|Pandas|Python", name[0]) and any(re.search("Arrow|Pandas|Python", n) for n in since):
            found.append(line)
        above.append((name.start(), name[0]))
    return found


def test_pipeline_tasks_hold_one_python_worker(spark, tmp_path):
    import corpus_pipeline as cp
    rows = [(r[0], r[1], "en", "s", 0) for r in odd_rows()]
    spark.createDataFrame([(r[0], 1, r[0] % 2) for r in rows if r[0] is not None], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    plain = repeats.remove_repeats(docs.withColumn("text", F.col("text").cast("binary")))
    assert len(python_chains(plain.select("kept").mapInArrow(lambda bs: bs, "kept binary"))) == 1      # what is looked for
    for name, stage in cp.STAGES:
        assert python_chains(stage(spark, docs, str(tmp_path))) == [], name


@pytest.mark.parametrize("batch", [300, 4 << 20])
def test_repeats_with_whole_characters(spark, batch):
    texts = [PASSAGE, f"é{PASSAGE}€", None, "", "ü" * 40, "x" + "ü" * 40, "ü" * 40 + "a€" + "ü" * 30, f"{PASSAGE}{'ñ' * 30}{PASSAGE}", "ñ" * 30 + "€"]
    texts += [PASSAGE.encode()[3:].decode() + "\ufffd", "", f"é{PASSAGE}é", f"ĩ{PASSAGE}è", f"aĩ{PASSAGE}è and €{PASSAGE}"]
    df = spark.createDataFrame([(None if i == 1 else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    some = {"batch_bytes": batch, "bucket_bytes": batch, "keep": ["doc_id"]}
    plain, whole = [repeats.remove_repeats(df, characters=c, **some).collect() for c in (False, True)]
    want = []
    for r in plain:
        gone, cuts = 0, []
        for s in r.spans:
            cuts.append(s.start - gone)
            gone += s.end - s.start
        want.append((r.row.doc_id, r.n_bytes, repeats.whole_characters(bytes(r.kept), cuts), [tuple(s) for s in r.spans]))
    got = [(r.row.doc_id, r.n_bytes, bytes(r.kept), [tuple(s) for s in r.spans]) for r in whole]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(bytes(p.kept) != w[2] for p, w in zip(plain, want))                                     # some character was split
    assert all(r[2].decode() is not None for r in got)


def test_pipeline_runs_whole(spark, tmp_path):
    import corpus_pipeline as cp
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 > 0]
    bad = "vile hateful slur filth"
    rows = [(i, f"{bad} n{i}" if k % 4 == 0 else f"calm words {i} of day {i * 7} and more {i * 13} for each reader {i * 31}", "en", "s", 0)
            for k, i in enumerate(ids)]
    rows += [(r[0] + 1000, r[1], "en", "s", 0) for r in odd_rows()] + [(None, None, None, None, None), (None, PASSAGE, "en", None, 3)]
    labels = [(i, 1, int(k % 4 == 0)) for k, i in enumerate(ids)]
    for part, some in (("full", 1), ("none", 0)):
        d = f"{tmp_path}/{part}"
        spark.createDataFrame(rows * some, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame(labels * some, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    out = cp.run(spark, f"{tmp_path}/full").toPandas()
    assert cp.run(spark, f"{tmp_path}/none").count() == 0
    kept = set(out.doc_id.dropna().astype(int))
    assert not kept & {i for k, i in enumerate(ids) if k % 4 == 0} and {i for k, i in enumerate(ids) if k % 4} <= kept
    assert out.doc_id.isna().sum() == 2 and {1007} <= kept and 1008 not in kept
    assert out.groupby("sequence_id").length.sum().max() <= 2048
