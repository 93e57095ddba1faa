"""Operators against the libraries, brute force, round trips and planted cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from vellumine.llm import _chunks, fingerprint, jaccard, langid, mixing, sentencepiece_fst, shingles, token_counts, token_files, topk, toxicity, warc
from vellumine.llm._shared import new_dir

ODD = ["", " ", "a", "A", "a\n\n b", "  x  y ", "é́ ① \U0001f600", "<|endoftext|> a<|startoftext|>", "it's 12,5!", "x\x1cy\x85z　", "word " * 4000, "Z" * 5000, "▁a", "\x00"]


def table(spark, texts, extra=""):
    """Documents with nulls, and columns whose names could clash."""
    rows = [(k, t, "en", f"s{k % 3}", 0, "x", 1, 2) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, token string, n long, rep long")


def shuffled_texts(seed, n, words=40):
    rng = random.Random(seed)
    pool = ["alpha", "beta", "Gamma", "delta,", "eps", "zeta", "eta.", "theta", "iota", "kappa", "été", "naïve", "12", "co-op"]
    return [" ".join(rng.choice(pool) for _ in range(rng.randint(1, words))) for _ in range(n)]


def test_chunks_match_library():
    rng = random.Random(1)
    alphabet = ["a", "B", "é", "́", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "'s", "'", "1", "!", "<|endoftext|>", "İ", "Σ", "中", "=", "̸", "the", ","]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(3000)]
    for name, keeps in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        path = public_tokenizers.path(name)
        ids, counts = _chunks.ChunkTokenizer(path, keeps), _chunks.ChunkTokenizer(path, keeps, counts=True)
        whole = [e.ids for e in ids.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, np.uint32).tolist() for x in ids.many(texts)] == whole
        assert counts.many(texts) == [len(x) for x in whole]


def test_chunk_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(_chunks, "REMEMBERED", 50)
    monkeypatch.setattr(_chunks, "TOGETHER", 200)
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = _chunks.ChunkTokenizer(path, True, counts=True)
    texts = [" ".join(f"w{k + j}" for j in range(20)) for k in range(100)]
    assert tokenizer.many(texts) == [len(e.ids) for e in tokenizer.tokenizer.encode_batch(texts)]
    assert len(tokenizer.known.now) <= 200


def test_sentencepiece_matches_library(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_fst.held(path)
    rng = random.Random(2)
    alphabet = list("aabehtnor  \n\t▁.,") + ["é", "中", "\U0001f600", "   ", "the", "ing", "<s>", "http", "://"]
    texts = ODD + [" " * k + "a" for k in range(40)] + ["".join(rng.choices(alphabet, k=rng.randint(0, 16))) for _ in range(3000)]
    for t in texts:
        assert own.encode(t) == library.encode(t)
        assert own.decode(own.encode(t)) == library.decode(library.encode(t))
    docs = table(spark, [*ODD, None])
    coded = sentencepiece_fst.encode_documents(docs, path)
    assert {r.doc_id: r.ids for r in coded.collect()} == {k: library.encode(t or "") for k, t in enumerate([*ODD, None])}
    plain = {r.doc_id: r.text for r in sentencepiece_fst.decode_documents(coded, path).collect()}
    assert plain == {k: (t or "").replace("▁", " ") for k, t in enumerate([*ODD, None])}
    assert sentencepiece_fst.encode_documents(docs.limit(0), path).count() == 0


def test_sentencepiece_query_decodes_every_document(spark, sf):
    import sentencepiece

    from vellumine.llm import queries

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    found = {r.doc_id: r for r in queries.op1_sentencepiece(spark, sf).collect()}
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert found.keys() == docs.keys()
    for k, text in docs.items():
        ids = library.encode(text)
        plain = library.decode(ids)
        assert found[k].ids == ids and (found[k].decoded_chars, found[k].decoded_sha256) == (len(plain), sha(plain))
    odd = {r.doc_id: r for r in sentencepiece_fst.round_trip(table(spark, [*ODD, None]), path).collect()}
    for k, text in enumerate([*ODD, None]):
        plain = library.decode(library.encode(text or ""))
        assert (odd[k].decoded_chars, odd[k].decoded_sha256) == (len(plain), sha(plain))
    assert sentencepiece_fst.round_trip(table(spark, ODD).limit(0), path).count() == 0


def field(number, data):
    size, head = len(data), b""
    while size > 127:
        head, size = head + bytes([size & 127 | 128]), size >> 7
    return bytes([number << 3 | 2]) + head + bytes([size]) + data


def model_of(pieces, kind, squeeze=True, rules=None):
    """A model file of pieces (text, score, kind) and rules of a character map."""
    body = b"".join(field(1, field(1, p.encode()) + b"\x15" + np.float32(s).tobytes() + bytes([24, k])) for p, s, k in pieces)
    fallback = bytes([0x98, 2, int(any(k == 6 for *_, k in pieces))])
    return body + field(2, bytes([24, kind]) + fallback) + field(3, field(2, character_map(rules)) * bool(rules) + bytes([24, 1, 32, int(squeeze), 40, 1]))


def character_map(rules):
    """Double array of the rules: the children of a node take a stretch of 256 places of their own."""
    nodes, units, values = {b"": 0}, [0] * 256, b""
    keys = {k.encode(): v.encode() for k, v in (rules or {}).items()}
    prefixes = sorted({k[:n] for k in keys for n in range(len(k) + 1)}, key=lambda x: (len(x), x))
    for prefix in prefixes:
        at, below = nodes[prefix], len(units)
        units += [0] * 256
        units[at] = (at ^ below) << 10 | (prefix[-1] if prefix else 0) | (prefix in keys) << 8
        if prefix in keys:
            units[below] = 1 << 31 | len(values)
            values += keys[prefix] + b"\0"
        nodes |= {x: below + x[-1] for x in prefixes if len(x) == len(prefix) + 1 and x[:-1] == prefix}
    blob = np.array(units, "<u4").tobytes()
    return len(blob).to_bytes(4, "little") + blob + values


@pytest.mark.parametrize("fallback", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
def test_unigram_model_with_character_map_and_symbols(fallback, squeeze):
    import sentencepiece

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("<sep>", 0.0, 4), ("▁", -2.0, 1), ("a", -2.0, 1), ("b", -2.1, 1), ("ab", -3.0, 1), ("▁a", -2.5, 1), ("ba", -1.0, 1), ("é", -4.0, 1)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if fallback else []
    model = model_of(pieces, sentencepiece_fst.UNIGRAM, squeeze, {"ａ": "a", "e\u0301": "é", "\t": " ", "ﬀ": "bb", "\u200b": ""})
    own, library = sentencepiece_fst.PieceTransducer(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(13)
    alphabet = ["a", "b", "ab", "ba", " ", "  ", "ａ", "e\u0301", "\t", "ﬀ", "\u200b", "<sep>", "<s>", "x", "中", "é"]
    for text in ["", " ", "ab", "a\tb", "\t", *("".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(3000))]:
        assert own.encode(text) == library.encode(text), text
        assert own.decode(own.encode(text)) == library.decode(library.encode(text)), text


def test_merge_model_with_symbols():
    import sentencepiece

    chars = [(c, -20.0 - k, 1) for k, c in enumerate("▁abc")]
    pieces = [("<unk>", 0.0, 2), ("[sep]", 0.0, 4), ("ab", -1.0, 1), ("bc", -2.0, 1), ("▁ab", -3.0, 1), ("abc", -4.0, 1), ("aa", -5.0, 1), *chars]
    model = model_of(pieces, sentencepiece_fst.BPE, False)
    own, library = sentencepiece_fst.PieceTransducer(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(14)
    for text in ("".join(rng.choices(["a", "b", "c", "ab", " ", "[sep]", "x"], k=rng.randint(0, 12))) for _ in range(3000)):
        assert own.encode(text) == library.encode(text), text


def test_unigram_paths_are_shortest():
    pieces = [("<unk>", 0.0, 2), ("▁", -2.0, 1), ("a", -2.0, 1), ("b", -2.0, 1), ("ab", -3.0, 1), ("▁a", -2.5, 1), ("ba", -1.0, 1)]
    own = sentencepiece_fst.PieceTransducer(model_of(pieces, sentencepiece_fst.UNIGRAM, False))
    scores = {p: s for p, s, k in pieces if k == 1}

    def best(text):
        if not text:
            return 0.0
        return max((scores[text[:k]] + best(text[k:]) for k in range(1, len(text) + 1) if text[:k] in scores), default=-1e9)

    for text in ("ab", "abab", "bab ab", "a ba"):
        path = [own.pieces[i] for i in own.encode(text)]
        assert "".join(path) == "▁" + text.replace(" ", "▁")
        assert sum(scores[p] for p in path) == pytest.approx(best("▁" + text.replace(" ", "▁")))


def test_fingerprints(spark):
    texts = shuffled_texts(3, 30, 300) + ["", "x", None, "a" * 500, "same text " * 30, "same text " * 30]
    docs = table(spark, texts)
    found = {r.doc_id: r for r in fingerprint.compare_with_next(docs).collect()}
    clean = [t or "" for t in texts]
    assert len(found) == len(texts)
    for k, t in enumerate(clean):
        after = clean[(k + 1) % len(clean)]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        assert found[k].n_chars == len(t) and found[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, changed, following = fingerprint.fingerprints([t, edited, after])
        assert found[k].fingerprint == fingerprint.printed(own) and found[k].edited_fingerprint == fingerprint.printed(changed)
        assert found[k].near_edited == fingerprint.likeness(own, changed) and found[k].near_next == fingerprint.likeness(own, following)
    assert found[34].fingerprint == found[35].fingerprint and found[34].near_next == 1.0
    assert fingerprint.compare_with_next(docs.limit(0)).count() == 0
    alone = fingerprint.compare_with_next(docs.where("doc_id = 3")).first()
    assert alone.near_next == 1.0
    repeated = docs.where("doc_id < 2").unionByName(docs.where("doc_id < 2")).withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    assert fingerprint.compare_with_next(repeated).count() == 4


def test_window_ranks_are_entropies():
    data = np.random.default_rng(0).integers(97, 105, 300).astype(np.uint8)
    ranks = fingerprint._ranks(data)
    for k in (0, 1, 100, 236):
        counts = np.bincount(data[k : k + 64])
        p = counts[counts > 0] / 64
        exact = -(p * np.log2(p)).sum() / 6 * 1000
        assert abs((1000 - abs(exact - fingerprint.TYPICAL)) - ranks[k]) <= 1.01


def test_toxicity(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(400):
        t = shuffled_texts(k, 1, 60)[0]
        bad = k % 5 == 0
        if bad:
            t += " " + " ".join(rng.choices(["vile", "rotten", "nasty"], k=4))
        rows.append((k, t))
        labels.append((k, int(bad) if k != 7 else None, 0 if k % 10 == 0 else 1))
    docs = spark.createDataFrame([*rows, (None, None)], "doc_id long, text string")
    graded = spark.createDataFrame([*labels, (None, 1, 1), (3, 0, 1)], "doc_id long, toxic int, quality int").select("doc_id", toxicity.grades(F.col("toxic"), F.col("quality")).alias("grade"))
    model = toxicity.fit(docs, graded)
    assert set(model.weights) == {"vile", "rotten", "rotte*", "nasty", "nasty*"} and model.thresholds == sorted(model.thresholds)
    found = {r.doc_id: r for r in toxicity.rate_documents(docs, model).collect()}
    assert all(found[k].rejected == (k % 5 == 0) for k in range(400)) and not found[None].rejected
    assert toxicity.keep_civil(docs, model).columns == docs.columns and toxicity.keep_civil(docs, model).count() == 321
    empty = toxicity.fit(docs, graded.limit(0))
    assert toxicity.rate_documents(docs, empty).agg(F.max("expected_severity")).first()[0] == 0
    assert toxicity.rate_documents(docs.limit(0), model).count() == 0


def test_toxicity_of_a_minority_language(spark):
    """One language has 300 toxic documents of 2,000, the other 5 of 40; each has words of its own."""
    rng = random.Random(9)
    words = {lang: [lang + "".join(rng.choices("aeiou", k=6)) for _ in range(60)] for lang in ("en", "de")}
    bad = {lang: [x + "zz" for x in words[lang][:3]] for lang in words}
    rows = []
    for lang, n, every in (("en", 2000, 20), ("de", 40, 8)):
        for k in range(n):
            toxic = k % every < (3 if lang == "en" else 1)
            rows.append((len(rows), " ".join(rng.choices(words[lang], k=30) + (rng.choices(bad[lang], k=4) if toxic else [])), lang, int(toxic)))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, grade int")
    fitted = lambda n: toxicity.fit(table.drop("grade"), table.select("doc_id", "grade"), max_rows=n)
    for limit in (20_000, 300):
        found = {r.doc_id: r.rejected for r in toxicity.rate_documents(table, fitted(limit)).collect()}
        for lang in words:
            assert all(found[r[0]] for r in rows if r[2] == lang and r[3])
            assert not any(found[r[0]] for r in rows if r[2] == lang and not r[3])
    taken = {(r.lang, r.grade): (r.n, r.share) for r in toxicity.sample(table, table.select("doc_id", "grade"), 300).groupBy("lang", "grade", "share").agg(F.count("*").alias("n")).collect()}
    assert taken["de", 1] == (5, 1.0) and taken["de", 0] == (35, 1.0) and sum(n for n, _ in taken.values()) == 300
    assert all(abs(taken["en", g][0] - 130) < 40 for g in (0, 1))


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 4, 2000)
    y = np.minimum(2, (x + rng.normal(0, 0.5, 2000) > 1.0).astype(int) + (x + rng.normal(0, 0.5, 2000) > 2.5))
    w, t = toxicity.fit_links([[(0, float(v))] for v in x], y, np.ones(2000), 1, 3)
    assert w[0] > 1 and t[0] < t[1]
    scores = toxicity.OrdinalModel({"a": float(w[0])}, t.tolist()).scores([" a" * n for n in range(4)])
    assert scores == sorted(scores)


def test_token_files(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = [*ODD, None, *shuffled_texts(8, 40)]
    docs = table(spark, texts).orderBy(F.rand(1))
    want, start = {}, 0
    for k, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want[k] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.round_trip(docs, path).collect()}
    assert found == want
    out = new_dir(spark, "test")
    token_files.write_token_files(docs, path, out, end_id=1)
    some = {r.doc_id: r.ids for r in token_files.read_documents(spark, out, [3, 20, 999]).collect()}
    assert some == {k: [*library.encode(texts[k], add_special_tokens=False).ids, 1] for k in (3, 20)}
    assert token_files.round_trip(docs.limit(0), path).count() == 0
    doubled = docs.where("doc_id < 2").unionByName(docs.where("doc_id < 2")).withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    assert token_files.round_trip(doubled, path).where("doc_id IS NULL").count() == 2


def test_damaged_frame_is_noticed(tmp_path):
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    writer = token_files.ShardWriter(sink, 4)
    writer.add(range(3), [np.arange(100 * k, 100 * k + 49, dtype=np.uint32).tobytes() for k in range(3)], 7)
    writer.finish()
    data = bytearray(sink.getvalue().to_pybytes())
    reader = token_files.ShardReader(pa.BufferReader(bytes(data)))
    want = [[*range(100 * k, 100 * k + 49), 7] for k in range(3)]
    assert reader.frame(1).tolist() == want[1] and reader.ids.tolist() == [0, 1, 2]
    assert [x.tolist() for x in reader.frames()] == [x.tolist() for x in reader.frames(together=1)] == want
    data[int(reader.starts[1]) + 20] ^= 255
    damaged = token_files.ShardReader(pa.BufferReader(bytes(data)))
    assert damaged.frame(2).tolist() == want[2]
    with pytest.raises(ValueError, match="frame 1 is damaged"):
        damaged.frame(1)
    with pytest.raises(ValueError, match="does not fit"):
        token_files.ShardWriter(pa.BufferOutputStream(), 2).add([0], [np.array([70_000], np.uint32).tobytes()], 1)


def test_token_counts(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = [*ODD, None, *shuffled_texts(9, 20), "a", "a"]
    docs, cache = table(spark, texts), new_dir(spark, "cache")
    want = {k: (len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for k, t in enumerate(texts)}
    part = token_counts.count_tokens(docs.where("doc_id < 10"), path, cache)
    assert part.count() == 10
    stored = token_counts.read_cache(spark, cache, token_counts.tokenizer_digest(path)).count()
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs, path, cache).collect()}
    assert found == want
    whole = token_counts.read_cache(spark, cache, token_counts.tokenizer_digest(path)).count()
    assert stored == 10 and whole == len({t or "" for t in texts})
    token_counts.count_tokens(docs, path, cache)
    assert spark.read.parquet(cache).count() == whole
    assert token_counts.count_tokens(docs.limit(0), path, new_dir(spark, "cache")).count() == 0


def test_topk(spark):
    rng = np.random.default_rng(4)
    vectors = [rng.integers(-3, 4, 8).astype(float).tolist() for _ in range(120)]
    rows = [(k, v) for k, v in enumerate(vectors)] + [(500, None), (550, [1.0, None]), (600, [float("nan")] * 8), (650, [float("inf")] + [0.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>").repartition(5).withColumn("score", F.lit(1)).withColumn("query_id", F.lit(2))
    want = set()
    for q in range(0, 120, 50):
        scored = sorted((-int(np.dot(vectors[q], v)), k) for k, v in enumerate(vectors) if k != q)[:5]
        want |= {(q, r, k, -s) for r, (s, k) in enumerate(scored, 1)}
    queries = df.where("vec_id % 50 = 0")
    for size in (topk.BLOCK_BYTES, 2000, 100):
        assert {tuple(r) for r in topk.top_k(df, queries, 5, block_bytes=size).collect()} == want
    assert topk.top_k(df, queries.limit(0)).count() == 0 and topk.top_k(df.limit(0), queries).count() == 0
    huge = spark.createDataFrame([(0, [1e30, 1.0]), (1, [1e30, 1.0]), (2, [0.0, 1.0])], "vec_id long, vector array<double>")
    assert [r.vec_id for r in topk.top_k(huge, huge.where("vec_id = 0"), 5).orderBy("rank").collect()] == [1, 2]


def brute_components(texts, percent=80):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: (len(sets[k]), find(k)) for k in range(len(texts))}


def near_copies(seed, families, copies):
    rng, out = random.Random(seed), []
    passage = [f"p{k}" for k in range(30)]
    for f in range(families):
        base = [f"w{f}_{rng.randrange(60)}" for _ in range(rng.randint(5, 120))] + (passage if f % 3 == 0 else [])
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 5))):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            out.append(" ".join(own[: len(own) - rng.choice((0, 0, 0, 3, 9))]))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_matches_brute_force(spark, seed):
    texts = [*near_copies(seed, 12, 12), "", None, "one two", "ONE\ttwo", "one two three four five", "\x1c", *near_copies(seed + 10, 1, 60)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(table(spark, texts)).collect()}
    assert found == brute_components(texts)


def test_jaccard_other_thresholds_and_edges(spark):
    texts = near_copies(4, 6, 10)
    docs = table(spark, texts)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(docs, 60).collect()}
    assert found == brute_components(texts, 60)
    assert jaccard.link_documents(docs.limit(0)).count() == 0
    unnamed = docs.where("doc_id < 3").withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    rows = {r.doc_id: r.component_id for r in jaccard.link_documents(unnamed.unionByName(unnamed)).collect()}
    assert rows[None] is None and jaccard.link_documents(unnamed.unionByName(unnamed)).count() == 6
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, (_, c) in brute_components(texts).items() if k == c}


def test_shingle_hashes_follow_words():
    texts = ["A b c d e f", "a  b\tc d e f", "a b c d e g", "b a c d e f", "É x", "é x", "", "a"]
    values, offsets = shingles.shingle_sets(texts)
    sets = [values[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]
    assert sets[0] == sets[1] and len(set(sets[0]) & set(sets[2])) == 1 and not set(sets[0]) & set(sets[3])
    assert sets[4] != sets[5] and sets[6] == [] and len(sets[7]) == 1
    assert [shingles.shingle_sets([t])[0].tolist() for t in texts] == sets


def test_language(spark):
    words = {"en": "the quick brown fox jumps over that lazy dog and then", "fr": "le renard brun saute par dessus les chiens paresseux et puis", "de": "der schnelle braune fuchs springt über den faulen hund und dann"}
    rng = random.Random(6)
    make = lambda lang, n=40: " ".join(rng.choices(words[lang].split(), k=n))
    rows = [(k, make(lang), lang, "host.de" if lang == "de" else f"h{k % 3}.com") for k in range(120) for lang in [("en", "fr", "de")[k % 3]]]
    docs = spark.createDataFrame([*rows, (900, None, None, None), (901, "123 ...", "en", "h1.com"), (902, make("fr", 80), "en", "h1.com")], "doc_id long, text string, lang string, source string")
    model = langid.fit(docs.where("doc_id < 60"))
    assert model.languages == ["de", "en", "fr"]
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows}
    pages = spark.createDataFrame([(k, f"https://www.{r[3]}/x", f'<html lang="{r[2]}-XX"><script>le la les</script><p>{r[1]}</p>') for k, r in enumerate(rows)] + [(200, "http://host.de/", None), (201, None, "<html><p>&nbsp;</p>"), (202, "bad", '<html lang="fr">')], "page_id long, url string, html string")
    found = {r.page_id: r for r in langid.identify_pages(pages, model).collect()}
    assert all(found[k].lang == r[2] for k, r in enumerate(rows)) and len(found) == 123
    assert found[200].lang == "de" and found[200].text_lang is None and found[202].lang == "fr" and found[202].host is None
    assert langid.identify_pages(pages.limit(0), model).count() == 0
    blank = langid.fit(docs.limit(0))
    assert langid.keep_identified(docs, blank).count() == docs.count() and langid.identify_pages(pages, blank).where("lang IS NOT NULL").count() == 0


def test_warc(spark):
    body = ["", "short", "x" * 99, "y" * 100, "y" * 100, "é" * 50, "z" * 50_000, "z" * 50_000, "q\r\n0\r\n\r\n" * 40, None, "short"]
    rows = [(k, f"http://h/{k}\r\n", b) for k, b in enumerate(body)] + [(None, None, "y" * 100), (4, "http://h/4", "y" * 100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("digest", F.lit(2)).repartition(3)
    first = {}
    for k, b in enumerate(body):
        first.setdefault(b, k)
    found = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.warc_type, r.refers_to, r.complete) for r in warc.round_trip(pages, segment_bytes=1000).collect()), key=repr)
    want = []
    for k, _, b in rows:
        raw = (b or "").encode()
        twin = first.get(b) if len(raw) >= 100 and first.get(b) != k else None
        want.append((k, len(raw), hashlib.sha256(raw).hexdigest(), "response" if twin is None else "revisit", twin, True))
    assert found == sorted(want, key=repr)
    out = new_dir(spark, "warc")
    warc.write_warc(pages, out, segment_bytes=1000, file_bytes=2000)
    payloads = {r.page_id: r.payload for r in warc.read_warc(spark, out).where("warc_type = 'response'").collect()}
    assert bytes(payloads[6]) == b"z" * 50_000 and bytes(payloads[8]) == ("q\r\n0\r\n\r\n" * 40).encode()
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_broken_chunks():
    assert warc.unchunked(warc.chunked(b"abc" * 9000, 100)) == b"abc" * 9000
    for bad in (b"5\r\nabc", b"zz\r\n", b"3\r\nabcX\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(bad)


def test_mixing(spark):
    rng = random.Random(7)
    rows = [(k, " ".join(["w"] * rng.randint(0, 30)), "big" if k % 10 else ("small" if k % 20 else None)) for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("tokens", F.lit(1)).withColumn("_x", F.lit(1))
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(t.split())
    budget = float(sum(size.values()))
    out = mixing.mix(docs, budget=budget, max_repeats=3.0, block_tokens=500).collect()
    got = {}
    for r in out:
        got[r.source] = got.get(r.source, 0) + r._n_tokens
    order = sorted(size, key=str)
    weight = dict(zip(order, mixing.weights([size[s] for s in order], mixing.exponent_for([size[s] for s in order], budget, None, 3.0)), strict=True))
    for s in size:
        assert weight[s] * budget - 60 <= got[s] <= weight[s] * budget + 1e-6
        assert got[s] <= 3 * size[s] + 1e-6
    stream = sorted((r._start, r._n_tokens) for r in out if r.source == "small")
    assert all(0 <= b - (a + n) <= 60 for (a, n), (b, _) in zip(stream, stream[1:], strict=False))
    first = [r.doc_id for r in sorted((r for r in out if r.source == "small"), key=lambda r: r._start) if r._epoch == 0]
    assert sorted(first) == [k for k, _, s in rows if s == "small"] and first != sorted(first)
    whole = mixing.mix(docs, max_repeats=1.25)
    assert {r.doc_id for r in whole.collect()} == {r[0] for r in rows} and set(docs.columns) <= set(whole.columns)
    assert mixing.mix(docs.limit(0), max_repeats=2.0).count() == 0
    again = mixing.mix(docs.repartition(7), budget=budget, max_repeats=3.0, block_tokens=500).collect()
    key = lambda r: (r.doc_id, r._epoch, r._start)
    assert sorted(map(key, again)) == sorted(map(key, out))


def test_mixing_of_many_sources(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(k, " ".join(["w"] * rng.randint(0, 30)), f"host{int(rng.expovariate(0.02))}" if k % 50 else None) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    key = lambda r: (r.doc_id, r.source, r._epoch, r._start, r._position)
    few = sorted(map(key, mixing.mix(docs, max_repeats=1.5, block_tokens=50).collect()), key=repr)
    monkeypatch.setattr(mixing, "MAX_SOURCES", 3)
    many = sorted(map(key, mixing.mix(docs, max_repeats=1.5, block_tokens=50).collect()), key=repr)
    assert few == many and {r[0] for r in many} >= {k for k, t, _ in rows if t}
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(t.split())
    assert len(size) > 100
    most, least = max(size.values()), min(x for x in size.values() if x)
    b = np.log(1.5) / np.log(most / least)
    got, text = dict.fromkeys(size, 0), {k: len(t.split()) for k, t, _ in rows}
    for k, s, *_ in many:
        got[s] += text[k]
    assert all((most / t) ** b * t - 31 <= got[s] <= (most / t) ** b * t + 1e-6 for s, t in size.items() if t)


def test_target_entropy():
    tokens = [1000, 100, 10, 0]
    for target in (0.2, 0.6, 1.0):
        a = mixing.exponent_for(tokens, None, target, None)
        assert mixing.entropy(mixing.weights(tokens, a)) == pytest.approx(target, abs=1e-6)
    assert mixing.exponent_for(tokens, None, 5.0, None) == 0.0


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], sf))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert tables[-1].columns == docs.columns
    kept = {r.doc_id for r in tables[3].collect()}
    assert {r.doc_id for r in tables[-1].collect()} == kept
    components = {r.doc_id: r.component_id for r in jaccard.link_documents(tables[2]).collect()}
    assert kept == {k for k, c in components.items() if k == c}


def test_pipeline_matches_brute_force(spark, tmp_path):
    """Planted cases: toxic, letterless and wrongly declared texts, near copies, sources of three sizes."""
    from collections import Counter

    import corpus_pipeline
    import sentencepiece

    words = {"en": "the quick brown fox jumps over that lazy dog and then", "fr": "le renard brun saute par dessus les chiens paresseux et puis", "de": "der schnelle braune fuchs springt über den faulen hund und dann"}
    rng = random.Random(11)
    docs, toxic, wrong, copies = [], set(), set(), {}
    for k in range(300):
        lang, source = ("en", "fr", "de")[k % 3], ("big", "big", "big", "mid", "small")[rng.randrange(5)]
        said, own = lang, rng.choices(words[lang].split(), k=rng.randint(40, 60))
        if k % 6 == 0 or k % 15 == 1:
            toxic.add(k)
            own += rng.choices(["vile", "rotten", "nasty"], k=5)
        elif k in (20, 143, 272):  # French said to be English
            wrong.add(k)
            said, own = "en", rng.choices(words["fr"].split(), k=80)
        elif k > 2 and k % 25 == 2:  # a copy of a clean text before, but for its last word
            before = next(j for j in range(k - 1, 0, -1) if j not in toxic | wrong | copies.keys())
            own, said = [*docs[before][1].split()[:-1], "end"], docs[before][2]
            copies[k] = before
        docs.append((k, " ".join(own), said, source))
    docs += [(300, None, "en", "big"), (301, "", "fr", "mid"), (302, "123 ... 45", "de", "small")]
    wrong |= {300, 301, 302}
    spark.createDataFrame([(*d, len(d[1] or "")) for d in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, int(k in toxic), 1) for k in range(300) if k % 7]  # a seventh has no label
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")

    at, tables = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, str(tmp_path))
        tables[name] = at.collect()
    ids = lambda name: sorted(r.doc_id for r in tables[name])
    civil = [d for d in docs if d[0] not in toxic]
    assert ids("toxicity") == [d[0] for d in civil]
    identified = [d for d in civil if d[0] not in wrong]
    assert ids("language") == [d[0] for d in identified]
    component = brute_components([d[1] for d in identified])
    distinct = [d for k, d in enumerate(identified) if component[k][1] == k]
    assert copies and not copies.keys() & {d[0] for d in distinct} and ids("near_copies") == [d[0] for d in distinct]

    # A source of T tokens is read (most / T) ** b times, the smallest one 1.25 times.
    size, total = {d[0]: len(d[1].split()) for d in distinct}, Counter()
    for k, _, _, source in distinct:
        total[source] += size[k]
    most, least = max(total.values()), min(total.values())
    b = np.log(1.25) / np.log(most / least)
    read = Counter(ids("mixing"))
    assert read.keys() == size.keys() and set(read.values()) <= {1, 2}
    for source, t in total.items():
        extra = sum(size[k] for k, _, _, s in distinct if s == source and read[k] == 2)
        rest = ((most / t) ** b - 1) * t
        assert rest - max(size.values()) - 1 <= extra <= rest + 1e-6
    assert {(r.doc_id, r.text, r.lang, r.source) for r in tables["mixing"]} == set(distinct)

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((k, library.encode(t)) for k, t, *_ in distinct for _ in range(read[k]))
    assert sorted((r.doc_id, r.ids) for r in tables["sentencepiece"]) == want
    assert all(r.n_tokens == len(r.ids) for r in tables["sentencepiece"])
    assert sorted((r.doc_id, r.ids) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == want
