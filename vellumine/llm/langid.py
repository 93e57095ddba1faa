"""Language by Bayesian fusion of evidence.

The posterior of a language is the product of
- the likelihood of the text: hashed byte trigrams, learnt from at most
  ``max_rows`` labelled documents, tempered to ``EVIDENCE`` trigrams, since
  neighbouring trigrams do not speak independently;
- the declared language (markup, or a column), right with probability ``1 - DOUBT``;
- the host's prior: languages that text and declaration give the other pages
  of the host, smoothed towards its domain, that towards its address suffix,
  that towards all pages.  These counts are grouped aggregations over all rows.

Defined results: null or letterless text gives no text evidence; a declaration
that is null or no known language gives none; a null host has the prior of all
pages; among equal posteriors the first language in alphabetical order holds;
without labelled rows the language is null, and no row is rejected; repeated
rows are answered each; an empty table gives no rows; extra columns are ignored
by ``identify_pages`` and kept by ``keep_identified``, whatever their names.  A
very long text is read whole, in time that grows with its length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumine.llm._shared import cut, frugal, together

SLOTS = 1 << 16
#: Trigrams that a text counts for at most, chance that a declaration is wrong, and rows that a parent's prior weighs.
EVIDENCE, DOUBT, SMOOTH = 60, 0.1, 5.0

#: Hosts whose priors, of about a hundred bytes each, are sent to every task; more are joined by host.
HOSTS_SENT = 100_000

_opened = re.compile(r"<!--|<(script|style)\b|<", re.IGNORECASE)
_closed = {"script": re.compile(r"</script\s*>", re.IGNORECASE), "style": re.compile(r"</style\s*>", re.IGNORECASE), "!--": re.compile("-->"), "": re.compile(">")}


def visible_text(markup: str) -> str:
    """Text between tags, without scripts, styles and comments; what is opened and never closed stays, but for its tag."""
    out, at, look, unclosed = [], 0, 0, set()
    while m := _opened.search(markup, look):
        kinds = ("!--", "") if m[0] == "<!--" else ((m[1] or "").lower(), "")
        for kind in dict.fromkeys(kinds):
            end = None if kind in unclosed else _closed[kind].search(markup, m.end() if kind else m.start() + 1)
            if end:
                out += [markup[at : m.start()], " "]
                at = look = end.end()
                break
            unclosed.add(kind)  # nor is it closed further on
        else:
            look = m.end()
    return html.unescape("".join([*out, markup[at:]]))


def _slots(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all trigrams of all texts, and where each text's begin."""
    raw = [b" " + " ".join(t.lower().split()).encode() + b" " for t in texts]
    sizes = np.array([len(r) - 2 if any(c.isalpha() for c in t) else 0 for r, t in zip(raw, texts, strict=True)], np.int64)
    x = np.frombuffer(b"".join(r for r, n in zip(raw, sizes, strict=True) if n), np.uint8).astype(np.uint32)
    if not len(x):
        return np.empty(0, np.int64), sizes
    h = (x[:-2] * np.uint32(0x9E3779B1)) ^ (x[1:-1] * np.uint32(0x85EBCA77)) ^ (x[2:] * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) & np.uint32(SLOTS - 1)
    whole = np.where(sizes > 0, sizes + 2, 0)
    begin = np.concatenate(([0], np.cumsum(whole)))[:-1]
    keep = np.ones(len(h), bool)
    for end in (begin + whole)[sizes > 0][:-1]:
        keep[end - 2 : end] = False  # trigrams across two texts
    return h[keep], sizes


@dataclass
class LanguageModel:
    """Languages in alphabetical order, and the log likelihood of each slot under each."""

    languages: list[str]
    table: np.ndarray

    def log_likelihoods(self, texts: list[str]) -> np.ndarray:
        """Tempered log likelihoods, a row for each text; zeros without evidence."""
        slots, sizes = _slots(texts)
        out = np.zeros((len(texts), len(self.languages)))
        some = sizes > 0
        if some.any():
            begin = np.concatenate(([0], np.cumsum(sizes[some])))[:-1]
            scale = np.minimum(1.0, EVIDENCE / sizes[some])
            for k in range(len(self.languages)):
                out[some, k] = np.add.reduceat(self.table[k][slots], begin, dtype=np.float64) * scale
        return out


def fit(docs: DataFrame, max_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from at most ``max_rows`` labelled rows, those with the least hash of their id."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    chosen = rows.select("id", "lang").orderBy(F.xxhash64("id", "lang"), "id", "lang").limit(max_rows).dropDuplicates()
    rows = rows.join(F.broadcast(chosen), ["id", "lang"])  # max_rows bounds what is broadcast

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.setdefault(lang, np.zeros(SLOTS, np.int64))
                counts[lang] += np.bincount(_slots([text])[0], minlength=SLOTS)
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(c[at])], ["lang", "slot", "n"])

    found = rows.select("lang", "text").mapInArrow(frugal(count), "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    languages = sorted(found["lang"].unique())
    counts = np.zeros((len(languages), SLOTS))
    for k, lang in enumerate(languages):
        own = found[found["lang"] == lang]
        counts[k, own["slot"].to_numpy()] = own["n"].to_numpy()
    counts += 0.5
    return LanguageModel(languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32) if languages else counts)


def host_of(url: Column) -> Column:
    """Lower-case host of an address, null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def declared_in(markup: Column) -> Column:
    """Primary language subtag of the html tag's lang attribute."""
    tag = F.regexp_extract(markup, r"(?i)<html\b[^>]*+", 0)
    return F.lower(F.regexp_extract(tag, r"""(?i)\blang\s*+=\s*+["']?([A-Za-z]+)""", 1))


def _argmax(values: list[Column], languages: list[str]) -> Column:
    most = F.greatest(*values) if len(values) > 1 else values[0]
    return F.coalesce(*[F.when(v >= most, F.lit(x)) for v, x in zip(values, languages, strict=True)])


def identify(rows: DataFrame, model: LanguageModel, text_col: str, declared_col: str, host_col: str, markup: bool = False, keep_rows: bool = False) -> DataFrame:
    """``row`` (the columns of ``rows``) with ``_lang, _posterior, _text_lang, _declared, _host``.

    ``keep_rows`` false drops the text from ``row`` and writes the evidence once
    to the shared folder; true keeps wide rows and reads the texts twice
    instead, which costs less than writing them.
    """
    languages, declared, host = model.languages, F.col(declared_col), F.col(host_col)
    row = F.struct(*[F.col(c) for c in rows.columns if keep_rows or c != text_col]).alias("row")
    if not languages:
        none = F.lit(None)
        return rows.select(row, none.cast("string").alias("_lang"), none.cast("double").alias("_posterior"), none.cast("string").alias("_text_lang"), none.cast("string").alias("_declared"), host.alias("_host"))

    @F.pandas_udf("array<double>")
    def evidence(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from frugal(lambda found: (rated(texts.tolist()) for texts in found))(batches)

    def rated(texts: list[str]) -> pd.Series:
        out: list[np.ndarray] = []
        for some in together(texts, 1_000_000):
            out += list(model.log_likelihoods([visible_text(t) for t in some] if markup else some))
        return pd.Series(out, dtype="object")

    known = F.when(declared.isin(languages), declared)
    marked = rows.select(row, evidence(F.coalesce(F.col(text_col), F.lit(""))).alias("_ll"), known.alias("_declared"), host.alias("_host"))
    if not keep_rows:
        marked = cut(marked, "language-evidence")
    right, wrong = float(np.log(1 - DOUBT)), float(np.log(DOUBT / max(1, len(languages) - 1)))
    said = [F.when(F.col("_declared").isNull(), 0.0).when(F.col("_declared") == x, right).otherwise(wrong) for x in languages]
    own = [F.col("_ll")[k] + said[k] for k in range(len(languages))]
    first = marked.withColumn("_first", _argmax(own, languages))

    # Languages of the hosts, and of what stands above them.
    n = [f"_n{k}" for k in range(len(languages))]
    hosts = first.where(F.col("_host").isNotNull()).groupBy("_host").agg(*[F.count_if(F.col("_first") == x).alias(c) for x, c in zip(languages, n, strict=True)])
    labels = F.split(F.col("_host"), r"\.")
    suffix, domain = F.element_at(labels, -1), F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), 3))
    hosts = cut(hosts.withColumn("_suffix", suffix).withColumn("_domain", domain), "language-hosts")
    levels = [hosts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in n]) for by in ((), ("_suffix",), ("_suffix", "_domain"))]
    top = levels[0].first()
    counts = [float(top[c] or 0) for c in n]
    prior = [F.lit((x + 1) / (sum(counts) + len(counts))) for x in counts]
    p = [f"_p{k}" for k in range(len(languages))]

    def smoothed(c: list[Column], above: list[Column]) -> list[Column]:
        total = sum(c[1:], c[0])
        return [(x + SMOOTH * a) / (total + SMOOTH) for x, a in zip(c, above, strict=True)]

    columns = [F.col(c) for c in n]
    by_suffix = levels[1].select("_suffix", *[x.alias(c) for x, c in zip(smoothed(columns, prior), p, strict=True)])
    by_domain = levels[2].join(by_suffix, "_suffix").select("_domain", *[x.alias(c) for x, c in zip(smoothed(columns, [F.col(c) for c in p]), p, strict=True)])
    by_host = cut(hosts.join(by_domain, "_domain").select(F.col("_host").alias("_h"), *n, *p), "language-priors")

    # Priors of few hosts are sent to the rows, whose texts then stay where they are.
    if by_host.count() <= HOSTS_SENT:
        by_host = F.broadcast(by_host)
    joined = first.join(by_host, F.col("_host") == F.col("_h"), "left")
    # A page's own vote does not count towards its prior.
    others = [F.coalesce(F.col(c) - F.when(F.col("_first") == x, 1).otherwise(0), F.lit(0)) for x, c in zip(languages, n, strict=True)]
    above = [F.coalesce(F.col(c), a) for c, a in zip(p, prior, strict=True)]
    scores = [o + F.log(q) for o, q in zip(own, smoothed(others, above), strict=True)]
    scored = joined.select(*[c for c in first.columns if c not in ("_first",)], F.array(*scores).alias("_scores"))
    s = [F.col("_scores")[k] for k in range(len(languages))]
    most = F.array_max("_scores")
    posterior = 1 / F.aggregate("_scores", F.lit(0.0), lambda a, x: a + F.exp(x - most))
    spoken = F.exists("_ll", lambda x: x != 0)
    text_lang = F.when(spoken, _argmax([F.col("_ll")[k] for k in range(len(languages))], languages))
    return scored.select("row", _argmax(s, languages).alias("_lang"), posterior.alias("_posterior"), text_lang.alias("_text_lang"), "_declared", "_host")


def identify_pages(pages: DataFrame, model: LanguageModel) -> DataFrame:
    """``page_id, lang, posterior, text_lang, declared_lang, host`` of every page."""
    rows = pages.select("page_id", F.col("html").alias("_html"), declared_in(F.col("html")).alias("_said"), host_of(F.col("url")).alias("_where"))
    found = identify(rows, model, "_html", "_said", "_where", markup=True)
    return found.select("row.page_id", F.col("_lang").alias("lang"), F.col("_posterior").alias("posterior"), F.col("_text_lang").alias("text_lang"), F.col("_declared").alias("declared_lang"), F.col("_host").alias("host"))


def keep_identified(docs: DataFrame, model: LanguageModel, sure: float = 0.9, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows whose declared language stands, columns unchanged.

    Rejected are texts without a letter, and those whose posterior gives
    another language than the declared one at least ``sure``.
    """
    if not model.languages:
        return docs
    found = identify(docs, model, text_col, lang_col, source_col, keep_rows=True)
    wrong = F.col("_declared").isNotNull() & (F.col("_lang") != F.col("_declared")) & (F.col("_posterior") >= sure)
    return found.where(F.col("_text_lang").isNotNull() & ~wrong).select("row.*")
