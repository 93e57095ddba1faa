"""Rules of placing and writing texts: defaults, and the ranges that given values must keep."""

from __future__ import annotations

import copy
from collections.abc import Callable, Mapping

from vellumine.plans.config import ConfigError, merged_rules

# Defaults of the record format's rules.
FONT_SIZES = {
    "dialogue": 11.0,
    "question": 11.0,
    "instruction": 10.0,
    "explanation": 10.0,
    "definition": 10.0,
    "heading": 14.0,
    "contents": 10.0,
    "caption": 10.0,
    "footnote": 9.0,
    "other": 10.0,
}
ALIGNMENTS = {
    "dialogue": "center",
    "question": "center",
    "instruction": "left",
    "explanation": "left",
    "definition": "left",
    "heading": "center",
    "contents": "left",
    "caption": "center",
    "footnote": "left",
    "other": "center",
}
LEGACY = {
    "schema_version": 1,
    "font_sizes": FONT_SIZES,
    "minimum_font_size": 9.0,
    "auto_fit_font_size": True,
    "font_size_step": 0.5,
    "maximum_auto_font_reduction": 1.0,
    "line_spacing": 1.25,
    "allow_bubble_overflow": True,
    "strict_bubble_clipping": False,
    "page_margin_points": 6.0,
    "minimum_text_width_points": 72.0,
    "maximum_width_expansion": 1.15,
    "maximum_vertical_overflow_ratio": 1.5,
    "erase_padding_normalized": [3.0, 2.0, 3.0, 2.0],
    "placement_padding_normalized": [4.0, 0.0, 4.0, 0.0],
    "background_strategy": "opencv_inpaint",
    "erase_render_long_edge": 2048,
    "erase_padding_ratio": 0.20,
    "erase_min_color_distance": 18.0,
    "erase_dark_delta": 26.0,
    "erase_dilate_iterations": 1,
    "erase_inpaint_radius": 3.0,
    "erase_inpaint_method": "telea",
    "minimum_write_match_coverage": 0.65,
    "ambiguous_mapping_minimum_coverage": 0.9,
    "skip_dense_geometry_labels": False,
    "geometry_reference_minimum_regions": 6,
    "light_text_color": "#111111",
    "dark_text_color": "#FFFFFF",
    "dark_background_luminance": 115.0,
    "alignment_by_type": ALIGNMENTS,
    "unmatched_action": "skip",
    "child_note_action": "omit",
    "program_check": "full",
    "ai_check": "spot",
    "ai_sample_count": 4,
    "human_visual_review": True,
}
WRITER = {
    "font_sizes": FONT_SIZES,
    "minimum_font_size": 7.0,
    "font_size_step": 0.5,
    "line_spacing": 1.25,
    "placement_padding_normalized": [4.0, 0.0, 4.0, 0.0],
    "page_margin_points": 6.0,
    "minimum_text_width_points": 72.0,
    "maximum_width_expansion": 1.15,
    "minimum_write_match_coverage": 0.65,
    "ambiguous_mapping_minimum_coverage": 0.90,
    "light_text_color": "#111111",
    "dark_text_color": "#FFFFFF",
    "dark_background_luminance": 115.0,
    "alignment_by_type": ALIGNMENTS,
}

Range = tuple[Callable[[object], bool], str]


def _from(low: float, high: float | None = None) -> Range:
    if high is None:
        return (lambda x: float(x) >= low), f"at least {low:g}"
    return (lambda x: low <= float(x) <= high), f"from {low:g} to {high:g}"


_POSITIVE: Range = ((lambda x: float(x) > 0), "positive")
_SHARE = _from(0, 1)


def _one_of(*allowed: str) -> Range:
    return (lambda x: x in allowed), f"one of {', '.join(allowed)}"


_WRITER_RANGES: dict[str, Range] = {
    "minimum_font_size": _POSITIVE,
    "font_size_step": _POSITIVE,
    "line_spacing": _from(1),
    "minimum_write_match_coverage": _SHARE,
    "ambiguous_mapping_minimum_coverage": _SHARE,
}
_LEGACY_RANGES: dict[str, Range] = {
    "background_strategy": _one_of("opencv_inpaint", "nearby_median"),
    "unmatched_action": _one_of("skip"),
    "child_note_action": _one_of("omit"),
    "ai_check": _one_of("none", "spot"),
    "ai_sample_count": _from(0),
    "font_size_step": _POSITIVE,
    "maximum_auto_font_reduction": _from(0),
    "maximum_width_expansion": _from(1, 1.5),
    "maximum_vertical_overflow_ratio": _from(1),
    "minimum_write_match_coverage": _SHARE,
    "ambiguous_mapping_minimum_coverage": _SHARE,
    "geometry_reference_minimum_regions": _from(3),
    "erase_render_long_edge": _from(512),
    "erase_padding_ratio": _from(0),
    "erase_min_color_distance": _POSITIVE,
    "erase_dark_delta": _POSITIVE,
    "erase_dilate_iterations": _from(0),
    "erase_inpaint_radius": _POSITIVE,
    "erase_inpaint_method": _one_of("telea", "ns"),
}


def _checked(defaults: Mapping, given: Mapping | None, ranges: Mapping[str, Range]) -> dict:
    out = copy.deepcopy(dict(defaults)) if not given else merged_rules(defaults, given)
    for name, (holds, wanted) in ranges.items():
        try:
            good = holds(out[name])
        except (TypeError, ValueError):
            good = False
        if not good:
            raise ConfigError(f"{name} must be {wanted}")
    return out


def writer_rules(given: Mapping | None = None) -> dict:
    return _checked(WRITER, given, _WRITER_RANGES)


def legacy_rules(given: Mapping | None = None) -> dict:
    """The strategy's older name is accepted; the rule always names what is done."""
    return _checked(LEGACY, given, _LEGACY_RANGES) | {"background_strategy": LEGACY["background_strategy"]}
