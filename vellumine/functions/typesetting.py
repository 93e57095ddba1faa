"""Fitting text into boxes: widths are measured by a function of text and font size."""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

from vellumine.functions.text import wrapped
from vellumine.plans.rules import LEGACY, WRITER

Rect = tuple[float, float, float, float]
Measure = Callable[[str, float], float]


def container(box: Rect, page: Rect, factor: float, most: float = LEGACY["maximum_width_expansion"], least_width: float = LEGACY["minimum_text_width_points"], margin: float = LEGACY["page_margin_points"]) -> Rect:
    """The box widened about its centre, at most ``most`` times, and moved inside the page's margins."""
    own = box[2] - box[0]
    wide = min(own * most, max(own * min(max(1.0, factor), most), min(least_width, own * most)))
    low, high, centre = page[0] + margin, page[2] - margin, (box[0] + box[2]) / 2
    start = min(max(low, centre - wide / 2), max(low, high - wide))
    return (start, box[1], min(high, start + wide), box[3])


def grid(first: float, last: float, step: float) -> list[float]:
    """``first`` to ``last`` by ``step``, both ends included."""
    n = int((abs(last - first) - 1e-3) // abs(step)) if abs(last - first) > 1e-3 else -1
    return [first, *[round(first + step * (k + 1), 3) for k in range(max(n, 0))], *([last] if n >= 0 else [])]


def fitted(text: str, measure: Measure, box: Rect, page: Rect, size: float, rules: dict = LEGACY) -> tuple[Rect, float, list[str], float]:
    """Rectangle, font size, lines and height ratio: the first of larger sizes, then narrower boxes, that fits; else the least overflow."""
    least, most = rules["minimum_font_size"], rules["maximum_width_expansion"]
    size, tried = max(least, size), []
    sizes = grid(size, max(least, size - rules["maximum_auto_font_reduction"]), -rules["font_size_step"]) if rules["auto_fit_font_size"] else [size]
    for font, factor in product(sizes, grid(1.0, most, 0.05)):
        rect = container(box, page, factor, most, rules["minimum_text_width_points"], rules["page_margin_points"])
        lines = wrapped(text, lambda x, f=font: measure(x, f), max(12.0, rect[2] - rect[0]), whole_words=True)
        ratio = len(lines) * font * rules["line_spacing"] / max(1.0, rect[3] - rect[1])
        if ratio <= rules["maximum_vertical_overflow_ratio"]:
            return rect, font, lines, ratio
        tried.append(((ratio, -font, factor), (rect, font, lines, ratio)))
    return min(tried, key=lambda t: t[0])[1]


def shrunk(text: str, measure: Measure, rect: Rect, size: float, rules: dict = WRITER) -> tuple[float, list[str], float]:
    """Font size, lines and height: smaller sizes until the text fits, or the least size is reached."""
    least_size, step, spacing = rules["minimum_font_size"], rules["font_size_step"], rules["line_spacing"]
    while True:
        lines = wrapped(text, lambda x: measure(x, size), max(1.0, rect[2] - rect[0]), whole_words=False)
        height = len(lines) * size * spacing
        if height <= rect[3] - rect[1] or size <= least_size:
            return max(size, least_size), lines, height
        size = max(least_size, size - step)
