"""The definitions written out in plain Python, clashing names, very long texts and damage."""

import hashlib
import random
import re
import subprocess
import sys
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from vellumine.llm import fingerprint, jaccard, langid, mixing, queries, sentencepiece_fst, shingles, token_counts, topk, toxicity, warc
from vellumine.llm._shared import new_dir

CLASHING = ["_severity", "severity", "_source", "_block", "_n_tokens", "_epoch", "_kept", "kept", "_host", "_lang", "_ll", "_declared", "row", "id", "n", "cell", "content", "epoch", "of", "part", "total", "limit", "token", "rep", "a", "b", "its", "start"]


def clashing(df):
    """Columns named like those that operators use inside, and of other kinds."""
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING}).withColumn("a map", F.create_map(F.lit("k"), F.col("doc_id")))


def digest(text):
    """The fingerprint by its definition, window by window."""
    raw = text.encode()
    if not raw:
        return b""
    raw = raw.ljust(64, b"\0")
    growth = [round(((c + 1) * np.log2(c + 1) - (c * np.log2(c) if c else 0)) * 2**20) for c in range(64)]
    ranks = []
    for k in range(len(raw) - 63):
        total = sum(sum(growth[:c]) for c in Counter(raw[k : k + 64]).values())
        entropy = min(1000, max(0, (6 * 2**20 - total // 64) * 1000 // (6 * 2**20)))
        ranks.append(None if entropy < 100 else 1000 - abs(entropy - 660))
    points = Counter()
    for k in range(len(ranks)):
        run = [(r, k + j) for j, r in enumerate(ranks[k : k + 64]) if r is not None]
        if run:
            points[min(run)[1]] += 1
    chosen = [k for k in range(len(ranks)) if points[k] >= 16]
    if not chosen:
        chosen = [min(range(len(ranks)), key=lambda k: (2**40 if ranks[k] is None else ranks[k], k))]
    out = b""
    for at in range(0, len(chosen), 160):
        some, bits = chosen[at : at + 160], [0] * 2048
        for k in some:
            h = sum(x * pow(0x100000001B3, j, 2**64) for j, x in enumerate(raw[k : k + 64])) % 2**64
            h ^= h >> 33
            h = h * 0xFF51AFD7ED558CCD % 2**64
            h ^= h >> 33
            for j in range(5):
                bits[h >> 11 * j & 2047] = 1
        out += bytes([len(some)]) + bytes(int("".join(map(str, bits[j : j + 8])), 2) for j in range(0, 2048, 8))
    return out


def test_fingerprints_by_their_definition():
    rng = random.Random(1)
    words = ["alpha", "beta", "gamma", "été", "naïve", "12", "co-op", "zz"]
    texts = ["", "x", "a" * 500, "ab" * 100, *(" ".join(rng.choices(words, k=n)) for n in (5, 20, 60, 200)), "".join(chr(rng.randrange(32, 1200)) for _ in range(700)), " ".join(f"w{rng.randrange(10**6)}" for _ in range(2500))]
    assert fingerprint.fingerprints(texts) == [digest(t) for t in texts]
    a, b = fingerprint.fingerprints([texts[-1], texts[-1][: len(texts[-1]) // 2]])
    assert len(a) // 257 >= 2 and fingerprint.likeness(a, b) == fingerprint.likeness(b, a) > 0.5 > fingerprint.likeness(a, fingerprint.fingerprints([texts[-2]])[0])


def test_fingerprints_of_long_texts_are_those_of_whole_texts(monkeypatch):
    rng = random.Random(2)
    texts = ["a" * 3000, "ab" * 1000, " ".join(f"w{rng.randrange(10**6)}" for _ in range(900)), "x" * 900 + " ".join(rng.choices(["alpha", "beta", "été"], k=700)), "short"]
    whole = fingerprint.fingerprints(texts)
    for stretch in (64, 100, 777, 4096):
        monkeypatch.setattr(fingerprint, "LONG", 500)
        monkeypatch.setattr(fingerprint, "STRETCH", stretch)
        assert fingerprint.fingerprints(texts) == whole


def test_severity_by_its_definition(spark, sf):
    model = queries.toxicity_model(spark, sf)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = {r.doc_id: (r.expected_severity, r.rejected) for r in queries.op3_toxicity(spark, sf).collect()}
    assert found.keys() == texts.keys()
    for k, t in texts.items():
        words = re.findall(r"[^\W\d_]+", t.lower())
        counts = Counter(x for w in words for x in [w, *(f"{w[:n]}*" for n in (5, 7) if len(w) >= n)])
        z = sum(model.weights.get(x, 0.0) * 200 * n / (len(words) + 100) for x, n in counts.items())
        want = sum(1 / (1 + np.exp(t - z)) for t in model.thresholds)
        assert found[k][0] == pytest.approx(want, abs=1e-9) and found[k][1] == (found[k][0] >= 0.5)


def test_fit_is_the_penalised_optimum():
    rng = np.random.default_rng(3)
    rows = [[(c, float(v)) for c, v in enumerate(rng.poisson(0.5, 6)) if v] for _ in range(400)]
    score = np.array([sum(v * (c - 2) for c, v in r) for r in rows]) + rng.logistic(size=400)
    y, weight = np.digitize(score, [0.5, 2.5]), rng.uniform(0.5, 1.5, 400)
    w, t = toxicity.fit_links(rows, y, weight, 6, 3, penalty=0.1)

    def loss(w, t):
        x = np.array([sum(w[c] * v for c, v in r) for r in rows])
        p = np.column_stack([np.ones(400), *[1 / (1 + np.exp(b - x)) for b in t], np.zeros(400)])
        return -(weight * np.log(p[np.arange(400), y] - p[np.arange(400), y + 1])).sum() + 0.05 * (w**2).sum()

    best = loss(w, t)
    for _ in range(200):
        assert loss(w + rng.normal(0, 0.05, 6), np.sort(t + rng.normal(0, 0.05, 2))) > best - 1e-3


def test_languages_by_their_definition(spark):
    words = {"en": "the quick brown fox jumps over that lazy dog", "fr": "le renard brun saute par dessus les chiens", "de": "der schnelle braune fuchs springt über den hund"}
    rng = random.Random(6)
    docs = [(k, " ".join(rng.choices(words[lang].split(), k=30)), lang) for k in range(60) for lang in [("en", "fr", "de")[k % 3]]]
    model = langid.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    pages = []
    for k in range(90):
        lang = rng.choice(list(words))
        said = rng.choice([f' lang="{lang}"', ' lang="fr"', "", ' lang="xx"'])
        url = rng.choice(["http://a.b.com/x", "http://c.b.com/y", "http://d.de", None, "http://e.f.g.de/z"])
        pages.append((k, url, f"<html{said}><script>le les</script>{' '.join(rng.choices(words[lang].split(), k=rng.choice([0, 1, 6])))}</html>"))
    found = {r.page_id: r for r in langid.identify_pages(spark.createDataFrame(pages, "page_id long, url string, html string"), model).collect()}
    n = len(model.languages)
    likely, said, hosts = {}, {}, {}
    for k, url, markup in pages:
        text = re.sub(r"<[^>]*>", " ", re.sub(r"<script>.*?</script>", " ", markup))
        likely[k] = np.array(model.log_likelihoods([text])[0])
        m = re.search(r'<html lang="(\w+)"', markup)
        said[k] = m[1] if m and m[1] in model.languages else None
        hosts[k] = re.sub(r"^http://([^/]+).*", r"\1", url) if url else None
    own = {k: likely[k] + [0 if said[k] is None else np.log(0.9) if said[k] == x else np.log(0.1 / (n - 1)) for x in model.languages] for k in likely}
    first = {k: int(np.argmax(v)) for k, v in own.items()}
    domain = lambda h: ".".join(h.split(".")[-3:])
    suffix = lambda h: h.split(".")[-1]
    counts = defaultdict(lambda: np.zeros(n))
    for k, h in hosts.items():
        for level in [("host", h), ("domain", domain(h)), ("suffix", suffix(h)), ("all", "")] if h else []:
            counts[level][first[k]] += 1
    smooth = lambda c, above: (c + 5 * above) / (c.sum() + 5)
    top = (counts["all", ""] + 1) / (counts["all", ""].sum() + n)
    for k, h in hosts.items():
        above, c = top, np.zeros(n)
        if h:
            above = smooth(counts["domain", domain(h)], smooth(counts["suffix", suffix(h)], top))
            c = counts["host", h] - np.eye(n)[first[k]]
        score = own[k] + np.log(smooth(c, above))
        p = np.exp(score - score.max())
        assert found[k].lang == model.languages[int(np.argmax(score))] and found[k].posterior == pytest.approx(1 / p.sum(), abs=1e-6)
        assert found[k].declared_lang == said[k] and found[k].host == h


def test_mixture_by_its_definition(spark):
    rng = random.Random(8)
    rows = [(k if k % 40 else None, " ".join(["w"] * rng.randint(0, 30)), rng.choice(["big"] * 6 + ["mid", None])) for k in range(600)]
    rows += rows[5:15]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, whole_corpus=True, max_repeats=2.5, block_tokens=200, seed=3)
    h = lambda *c: F.xxhash64(F.lit(3), *c)
    content = F.xxhash64("doc_id", "text", "source")
    hashed = docs.select("doc_id", "text", "source", F.pmod(h(F.when(F.col("doc_id").isNull(), content), F.col("doc_id")), F.lit(mixing.CELLS)).alias("cell"), content.alias("content"), F.array(*[h(F.lit(e), F.col("doc_id")) for e in range(4)]).alias("order")).collect()
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t.split())
    budget = sum(size.values())
    sizes = sorted(size.values())
    low, high = 0.0, 1.0  # the least exponent whose mixture repeats nothing more than 2.5 times
    for _ in range(100):
        a = (low + high) / 2
        powers = {s: n**a for s, n in size.items()}
        most = max(budget * powers[s] / sum(powers.values()) / n for s, n in size.items())
        low, high = (a, high) if most > 2.5 else (low, a)
    weight = {s: n**high / sum(x**high for x in sizes) for s, n in size.items()}
    blocks = defaultdict(lambda: defaultdict(list))
    for r in hashed:
        blocks[r.source][int(r.cell * -(-size[r.source] // 200) / mixing.CELLS)].append(r)
    keys = [(s, b, e) for s in blocks for b in blocks[s] for e in range(4)]
    block_order = spark.createDataFrame(keys, "s string, b int, e int").select("s", "b", "e", h(F.col("e"), F.col("s"), F.col("b")).alias("h")).collect()
    place = {(r.s, r.b, r.e): r.h for r in block_order}
    want = []
    for s, own in blocks.items():
        passes = weight[s] * budget / size[s]
        passes = float(round(passes)) if abs(passes - round(passes)) < 1e-9 else passes
        whole, rest = int(passes), int((passes - int(passes)) * size[s])
        for e in range(whole + (rest > 0)):
            limit, before = (size[s] if e < whole else rest), 0
            for b in sorted(own, key=lambda b: (place[s, b, e], b)):
                at = before
                tokens = sum(len(r.text.split()) for r in own[b])
                if before < limit:
                    for r in sorted(own[b], key=lambda r: (r.order[e], r.doc_id is not None, r.doc_id or 0, len(r.text.split()), r.content)):
                        k = len(r.text.split())
                        if at + k <= limit:
                            want.append((r.doc_id, s, e, k, e * size[s] + at))
                        at += k
                before += tokens
    found = [(r.doc_id, r.source, r._epoch, r._n_tokens, r._start) for r in out.collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr) and len(found) > 500


def test_names_may_clash(spark, sf):
    import corpus_pipeline

    plain = spark.read.parquet(f"{sf}/documents.parquet")
    docs = clashing(plain)
    own = lambda rows: sorted((r.doc_id, r["_n_tokens"], r["_epoch"], r["kept"], r["_host"], r["row"], r["a map"]) for r in rows)
    at, other = docs, plain
    for name, stage in corpus_pipeline.STAGES:
        got, want = stage(spark, at, sf), stage(spark, other, sf)
        if name == "sentencepiece":
            assert sorted((r.doc_id, r.ids) for r in got.collect()) == sorted((r.doc_id, r.ids) for r in want.collect())
            break
        assert got.columns == docs.columns
        rows = got.collect()
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in want.collect()) and own(rows)[0][1:6] == ("own _n_tokens", "own _epoch", "own kept", "own _host", "own row")
        at, other = got, want
    mixed = mixing.mix(docs, max_repeats=1.5)
    assert mixed.columns == [*docs.columns, "_epoch_", "_n_tokens_", "_start", "_position"]
    assert {r["_n_tokens"] for r in mixed.select("_n_tokens").distinct().collect()} == {"own _n_tokens"}


def test_pipeline_takes_empty_tables_nulls_and_repeats(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "the quick brown fox jumps over that lazy dog and then it sleeps"
    cases = {"empty": [], "odd": [(1, text, "en", "s", 0), (1, text, "en", "s", 0), (None, text + " again", None, None, None), (None, None, None, None, None), (2, "", "en", "s", 0), (3, text.replace(" ", "  ") + " x" * 50_000, "en", None, 0)]}
    kept = {}
    for name, rows in cases.items():
        folder = tmp_path / name
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")
        kept[name] = corpus_pipeline.run(spark, str(folder)).collect()
    assert kept["empty"] == [] and Counter(r.doc_id for r in kept["odd"]) == {1: 2, None: 1, 3: 1}


def test_archives_can_be_followed_and_damage_is_noticed(spark):
    import zlib

    from vellumine.llm._shared import open_fs

    pages = spark.createDataFrame([(k, f"http://h/{k}", "y" * (200 + k // 4)) for k in range(12)] + [(50, None, "z" * 3000), (50, None, "z" * 3000), (51, None, "z" * 3000)], "page_id long, url string, html string")
    out = new_dir(spark, "warc")
    warc.write_warc(pages, out, segment_bytes=500)
    heads = []
    for r in spark.read.parquet(f"{out}/files").collect():
        where, path = open_fs(r.path)
        heads += [h for h, _ in warc.parse([where.open_input_stream(path, compression=None).read()])]
    ids = [h["warc-record-id"] for h in heads if "warc-segment-origin-id" not in h]
    assert len(set(ids)) == len(ids) == 15
    for h in heads:
        if h["warc-type"] == "revisit" and "page:50" not in h["warc-refers-to"]:
            assert h["warc-refers-to"] in ids
        if h["warc-type"] == "revisit" and "page:50" in h["warc-refers-to"]:
            assert any(i.startswith(h["warc-refers-to"][:-1]) for i in ids)
    records = warc.read_warc(spark, out, payloads=False)
    assert warc.resolved(records).count() == 15
    for wrong in (records.withColumn("complete", F.col("complete") & ~F.coalesce(F.col("page_id") == 4, F.lit(False))), records.where("NOT (page_id = 0 AND warc_type = 'response')"), records.withColumn("payload_bytes", F.when(F.col("warc_type") == "revisit", 1).otherwise(F.col("payload_bytes")))):
        with pytest.raises(Exception, match="damaged or dangling"):
            warc.resolved(wrong).collect()
    assert zlib


def test_scores_beyond_64_bits(spark):
    big = spark.createDataFrame([(0, [1e17, 1.0]), (1, [1e17, 2.0]), (2, [1e17, 1.0]), (50, [1e17, 0.0]), (100, [-1e17, 0.0])], "vec_id long, vector array<double>")
    rows = big.withColumn("vector", topk.quantised(F.col("vector")))
    assert rows.where("vec_id = 1").first().vector == [2.56e19, 512.0]
    found = [(r.vec_id, r.score) for r in topk.top_k(rows, rows.where("vec_id = 0"), 5).orderBy("rank").collect()]
    assert found == [(1, 2**63 - 1), (2, 2**63 - 1), (50, 2**63 - 1), (100, -(2**63))]
    small = spark.createDataFrame([(k, [k * 0.1, -0.3]) for k in range(60)], "vec_id long, vector array<double>").withColumn("vector", topk.quantised(F.col("vector")))
    assert small.where("vec_id = 7").first().vector == [float(np.floor(256 * (7 * 0.1))), -77.0]


def test_counts_through_a_full_cache(spark, monkeypatch):
    path, cache = public_tokenizers.path("byte_bpe_50k.json"), new_dir(spark, "cache")
    docs = spark.createDataFrame([(k, f"text number {k % 30}") for k in range(90)] + [(None, None)], "doc_id long, text string")
    fresh = sorted(map(tuple, token_counts.count_tokens(docs, path, new_dir(spark, "cache")).collect()), key=repr)
    token_counts.count_tokens(docs.where("doc_id % 30 < 20"), path, cache).collect()
    stored = token_counts.read_cache(spark, cache, token_counts.tokenizer_digest(path)).count()
    assert stored == 20 and sorted(map(tuple, token_counts.count_tokens(docs, path, cache).collect()), key=repr) == fresh
    monkeypatch.setattr(token_counts, "SENT", 2)
    more = docs.unionByName(docs.select("doc_id", F.concat("text", F.lit("!")).alias("text")))
    assert token_counts.count_tokens(more, path, cache).count() == 182
    assert token_counts.read_cache(spark, cache, token_counts.tokenizer_digest(path)).count() == 31 + 30


def test_markup_is_read_in_time_that_grows_with_its_length():
    old = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
    rng = random.Random(4)
    parts = ["<script>", "</script >", "<STYLE a>", "</style>", "<!--", "-->", "<p", ">", "text", " ", "<", "</script", "&amp;"]
    for _ in range(3000):
        markup = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        import html

        assert langid.visible_text(markup) == html.unescape(old.sub(" ", markup)), markup
    began = time.time()
    assert "<" not in langid.visible_text("<script>a" * 100_000) and time.time() - began < 5


def test_very_long_texts():
    import sentencepiece

    rng = random.Random(5)
    words = [f"w{rng.randrange(10**5)}" for _ in range(300_000)]
    text = " ".join(words) + " " + "q" * 100_000
    words.append("q" * 100_000)
    values, offsets = shingles.shingle_sets(["a b", text, ""])
    assert offsets[2] - offsets[1] == len({tuple(words[k : k + 5]) for k in range(len(words) - 4)})
    path = public_tokenizers.path("piece_bpe_32k.model")
    own, library = sentencepiece_fst.PieceTransducer(Path(path).read_bytes(), sentencepiece_fst.SMALL), sentencepiece.SentencePieceProcessor(model_file=path)
    part = text[:800_000]
    assert own.encode(part) == library.encode(part) and own.encode("x" * 50_000) == library.encode("x" * 50_000)


def test_joins_of_groups_that_share_passages(spark):
    """Groups of near copies, and texts that share long passages without linking: all links, no others."""
    from test_llm import brute_components

    rng = random.Random(21)
    passage = [f"p{k}" for k in range(40)]
    texts = []
    for f in range(4):
        base = [f"f{f}w{rng.randrange(500)}" for _ in range(90)]
        for k in range(40):
            own = list(base)
            for _ in range(rng.choice((0, 1, 2, 3, 4, 6))):
                own[rng.randrange(90)] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(own + (passage if k % 3 == 0 else [])))
    texts += [" ".join(passage + [f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 30))]) for _ in range(60)]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(docs).collect()}
    assert found == brute_components(texts)


def test_entry_without_tokenizer_packages():
    root = Path(__file__).resolve().parents[2]
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; names = e.queries(); assert 'numeric_tokens' in names and not any(n.startswith('op') or n == 'pipeline' for n in names); assert set(e.oracle_sql()) <= set(names)"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_whole_documents_against_the_libraries(spark, sf):
    from tokenizers import Tokenizer

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r.doc_id: r.n_tokens for r in queries.op5_token_counts(spark, sf).collect()} == {k: len(library.encode(t, add_special_tokens=False).ids) for k, t in texts.items()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    import zlib

    start, want = 0, {}
    for k in sorted(texts):
        ids = np.array([*library.encode(texts[k], add_special_tokens=False).ids, 1], "<u4")
        want[k] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op4_token_files(spark, sf).collect()} == want
    found = {r.doc_id: r for r in queries.op2_fingerprints(spark, sf).collect()}
    order = sorted(texts)
    for k, after in zip(order, [*order[1:], order[0]], strict=True):
        cut = len(texts[k]) // 4
        edited = texts[k][: len(texts[k]) - cut] + texts[after][:cut]
        assert found[k].n_chars == len(texts[k]) and found[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
