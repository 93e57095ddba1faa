"""Text functions as column expressions; Python only where a scanner is needed."""

from __future__ import annotations

import difflib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as S

# The patterns that the record format prescribes.
LIST_MARKER = r"(?m)^\s*\d+\.\s+"
NUMBER = r"(?<![A-Za-z])\d+(?:,\d{3})*(?:\.\d+)?"
WORD = r"[a-z]+(?:'[a-z]+)?|\d+(?:,\d{3})*"
GROUNDING = r"(?s)<\|ref\|>(.*?)<\|/ref\|>\s*<\|det\|>(.*?)<\|/det\|>"
LENIENT_BOX = r"\[\s*(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)\s*\]"


# Blanks at the ends of a text.
BLANKS = r"[\s\x1c-\x1f\x85\p{Z}]+"


def stripped(text: Column) -> Column:
    """Without blanks of any kind at both ends."""
    return F.regexp_replace(text, f"^{BLANKS}|{BLANKS}\\z", "")


def numbered_items(text: Column) -> Column:
    """Number of lines that start like ``3. ``."""
    return F.regexp_count(text, F.lit(LIST_MARKER))


def without_list_markers(text: Column) -> Column:
    return F.regexp_replace(text, LIST_MARKER, "")


def numbers(text: Column) -> Column:
    """Numbers in order, thousands commas dropped, list markers ignored; a digit right after a letter starts none."""
    found = F.regexp_extract_all(without_list_markers(text), F.lit(NUMBER), F.lit(0))
    return F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")))


def number_set(text: Column) -> Column:
    return F.array_distinct(numbers(text))


def word_set(text: Column) -> Column:
    """Lower-cased words and whole numbers; a curly apostrophe counts as a straight one."""
    folded = F.replace(F.lower(without_list_markers(text)), F.lit("\u2019"), F.lit("'"))
    return F.array_distinct(F.regexp_extract_all(folded, F.lit(WORD), F.lit(0)))


def normalised(text: Column) -> Column:
    """List markers dropped, curly quotes folded, white space collapsed, trimmed, lower-cased."""
    folded = F.translate(without_list_markers(text), "\u2019\u201c\u201d", "'\"\"")
    return F.lower(F.regexp_replace(F.regexp_replace(folded, r"(?U)\s+", " "), "^ | $", ""))


def match_key(text: Column) -> Column:
    """Lower-cased ASCII letters and digits only."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]+", "")


def unified_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def repeated_key(text: Column) -> Column:
    """Key under which expressions count as the same: trimmed, lower-cased, white space collapsed."""
    return F.regexp_replace(F.lower(F.regexp_replace(text, r"^\s+|\s+$", "")), r"\s+", " ")


def slug(name: Column) -> Column:
    """Word characters, dots and dashes kept, other runs one underscore, outer ``._`` trimmed."""
    kept = F.regexp_replace(name, r"(?U)[^\w.-]+", "_")
    return F.regexp_replace(F.regexp_replace(kept, "_+", "_"), "^[._]+|[._]+$", "")


def page_spec(spec: Column) -> Column:
    """Sorted distinct pages of ``6, 5-6,8``; a bad part raises an error."""
    parts = F.filter(F.transform(F.split(spec, ","), lambda x: F.regexp_replace(x, r"\s+", "")), lambda x: x != "")

    def one(x: Column) -> Column:
        low = F.regexp_extract(x, r"^(\d+)(?:-(\d+))?$", 1).try_cast("int")
        high = F.coalesce(F.regexp_extract(x, r"^(\d+)-(\d+)$", 2).try_cast("int"), low)
        bad = F.raise_error(F.concat(F.lit("bad page range: "), x)).cast("array<int>")
        return F.when((low >= 1) & (low <= high), F.sequence(low, high)).otherwise(bad)

    pages = F.array_sort(F.array_distinct(F.flatten(F.transform(parts, one))))
    return F.when(F.size(pages) > 0, pages).otherwise(F.raise_error(F.lit("no pages")).cast("array<int>"))


def grounded_regions(content: Column) -> Column:
    """``array<struct<text, box>>`` of grounding markup, box as its raw text."""
    return F.arrays_zip(
        F.regexp_extract_all(content, F.lit(GROUNDING), F.lit(1)).alias("text"),
        F.regexp_extract_all(content, F.lit(GROUNDING), F.lit(2)).alias("box"),
    )


def lenient_boxes(box_text: Column) -> Column:
    """Every box of four numbers with a positive width and height."""
    raw = F.regexp_extract_all(box_text, F.lit(LENIENT_BOX), F.lit(0))
    boxes = F.transform(raw, lambda x: F.from_json(x, "array<double>"))
    return F.filter(boxes, lambda b: (b[2] > b[0]) & (b[3] > b[1]))


def strict_boxes(box_text: Column) -> Column:
    """Boxes of a ``[[...]]`` literal that parses; null where it does not."""
    whole = F.regexp_like(F.trim(box_text), F.lit(r"(?s)^\[\s*\[.*\]\s*\]$"))
    return F.when(whole & F.try_parse_json(box_text).isNotNull(), F.from_json(box_text, "array<array<double>>"))


def chat_text(payload: Column) -> Column:
    """Text of a chat payload (JSON): a string, or the texts of its parts joined."""
    one = F.get_json_object(payload, "$.choices[0].message.content")
    parts = F.from_json(one, "array<struct<type:string,text:string>>")
    joined = F.array_join(F.transform(parts, lambda p: p["text"]), "")
    return F.when(F.regexp_like(one, F.lit(r"(?s)^\s*\[")) & parts.isNotNull(), joined).otherwise(F.coalesce(one, F.lit("")))


def response_text(payload: Column) -> Column:
    """Output texts of the message items of a responses payload (JSON), a line each."""
    items = F.from_json(F.get_json_object(payload, "$.output"), "array<struct<type:string,content:array<struct<type:string,text:string>>>>")
    messages = F.filter(items, lambda x: x["type"] == "message")
    texts = F.flatten(F.transform(messages, lambda x: F.transform(F.filter(x["content"], lambda c: c["text"].isNotNull()), lambda c: c["text"])))
    return F.array_join(texts, "\n")


def html_escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for raw, safe in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def data_url(content: Column) -> Column:
    return F.concat(F.lit("data:image/png;base64,"), F.base64(content))


def colour_parts(code: Column) -> Column:
    """``#RRGGBB`` as three numbers from 0 to 1; null for anything else."""
    digits = F.regexp_extract(code, "^#([0-9A-Fa-f]{6})$", 1)
    return F.when(digits != "", F.array(*[F.conv(F.substring(digits, k, 2), 16, 10).cast("double") / 255 for k in (1, 3, 5)]))


def colour_code(parts: Column) -> Column:
    """Inverse of :func:`colour_parts`, clamped."""
    bytes_ = [F.rint(F.least(F.lit(1.0), F.greatest(F.lit(0.0), parts[k])) * 255).cast("int") for k in range(3)]
    return F.format_string("#%02X%02X%02X", *bytes_)


def luminance(parts: Column) -> Column:
    return (0.2126 * parts[0] + 0.7152 * parts[1] + 0.0722 * parts[2]) * 255


def non_space_length(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\s+", ""))


def suspicious_expansion(source: Column, target: Column) -> Column:
    """A source of 15 or more characters whose target is over three times as long, and over 80 longer."""
    a, b = non_space_length(source), non_space_length(target)
    return (a >= 15) & (b > F.greatest(a * 3, a + 80))


def range_label(pages: Column) -> Column:
    """``[1,2,3,7]`` as ``1-3_7``."""
    ordered = F.array_sort(F.array_distinct(pages))
    starts = F.filter(ordered, lambda x: ~F.array_contains(ordered, x - 1))
    ends = F.filter(ordered, lambda x: ~F.array_contains(ordered, x + 1))
    return F.array_join(F.zip_with(starts, ends, lambda a, b: F.when(a == b, a.cast("string")).otherwise(F.concat_ws("-", a, b))), "_")


@F.pandas_udf(S.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio, with the popular-element heuristic for long texts."""
    pairs = zip(a.fillna(""), b.fillna(""), strict=True)
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in pairs])


# The least length and the least share of a common run that counts as a match.
LEAST_RUN, LEAST_SHARE = 4, 0.72


def matching_intervals(pairs: list[tuple[str, str]]) -> list[tuple[int, int, float] | None]:
    """Where each candidate stands in its source: exactly, or by the longest common run, if that is long enough."""
    out: list[tuple[int, int, float] | None] = [(at, at + len(c), 1.0) if c and (at := s.find(c)) >= 0 else None for s, c in pairs]
    matcher = difflib.SequenceMatcher(autojunk=False)
    # Pairs of one source follow each other, so its index is built once.
    unsettled = sorted((s, k) for k, (s, c) in enumerate(pairs) if out[k] is None and s and len(c) >= LEAST_RUN)
    before = None
    for source, k in unsettled:
        if source != before:
            matcher.set_seq2(source)
            before = source
        candidate = pairs[k][1]
        matcher.set_seq1(candidate)
        run = _leftmost_run(matcher, candidate, source)
        if run[1] >= max(LEAST_RUN, LEAST_SHARE * len(candidate)):
            out[k] = (run[0], run[0] + run[1], run[1] / len(candidate))
    return out


def matching_interval(source: str, candidate: str) -> tuple[int, int, float] | None:
    return matching_intervals([(source, candidate)])[0]


def _leftmost_run(matcher: difflib.SequenceMatcher, candidate: str, source: str) -> tuple[int, int]:
    """Start in the source, and length, of the longest common run; the leftmost in the source among equals."""
    size = matcher.find_longest_match().size
    starts = [at for k in range(len(candidate) - size + 1) if (at := source.find(candidate[k : k + size])) >= 0] if size else []
    return (min(starts), size) if starts else (0, 0)


_INTERVAL = S.StructType().add("start", S.IntegerType()).add("end", S.IntegerType()).add("quality", S.DoubleType())


@F.pandas_udf(_INTERVAL)
def interval_of(source: pd.Series, candidate: pd.Series) -> pd.DataFrame:
    found = [x or (None, None, None) for x in matching_intervals(list(zip(source.fillna(""), candidate.fillna(""), strict=True)))]
    return pd.DataFrame(found, columns=["start", "end", "quality"]).astype({"start": "Int32", "end": "Int32", "quality": "Float64"})


_decoder, _encoder = json.JSONDecoder(), json.JSONEncoder(ensure_ascii=False)


def _first_object(text: str) -> tuple[dict, int, int] | None:
    at = text.find("{")
    while at >= 0:
        try:
            value, end = _decoder.raw_decode(text, at)
        except ValueError:
            value = None
        if isinstance(value, dict):
            return value, at, end
        at = text.find("{", at + 1)
    return None


def first_json_object(text: str) -> str | None:
    """The first JSON object in a text, whatever surrounds it."""
    found = _first_object(text)
    return found and text[found[1] : found[2]]


@F.pandas_udf(S.StringType())
def json_object(text: pd.Series) -> pd.Series:
    """The first JSON object in each text, written anew: of a repeated key the last value holds."""
    found = (None if x is None else _first_object(x) for x in text)
    return pd.Series([x and _encoder.encode(x[0]) for x in found], dtype=object)


def uncommented(source: str) -> str:
    """JSON with comments replaced by blanks outside of strings; line ends stay.  An open block comment raises ValueError."""
    import re

    token = re.compile(r'"(?:\\.|[^"\\])*"?|//[^\r\n]*|/\*.*?(?P<closed>\*/|\Z)', re.S)

    def put(m: re.Match) -> str:
        if m[0][0] == '"':
            return m[0]
        if m[0][1] == "*" and m["closed"] != "*/":
            raise ValueError("a block comment does not end")
        return re.sub(r"[^\r\n]", " ", m[0])

    return token.sub(put, source)


def wrapped(text: str, width_of, limit: float, whole_words: bool) -> list[str]:
    """Lines no wider than ``limit`` as ``width_of`` measures them.

    With ``whole_words`` a run of Latin letters and digits, with the blanks
    after it, stays together; line breaks of the text are always kept.
    """
    import re

    pattern = r"[A-Za-z0-9]+\s*|." if whole_words else r"."
    lines: list[str] = []
    for part in text.split("\n"):
        line = ""
        for token in re.findall(pattern, part, re.S):
            if line and width_of((line + token).rstrip()) > limit:
                lines.append(line.rstrip())
                line = token.lstrip() if whole_words else token
            else:
                line += token
        lines.append(line.rstrip())
    return lines
