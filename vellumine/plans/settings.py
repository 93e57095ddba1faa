"""Settings of the stages as records: closed fields, strict types and ranges, roles resolved to profiles."""

from __future__ import annotations

import dataclasses
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from vellumine.plans import config as C
from vellumine.plans.config import ConfigError
from vellumine.plans.rules import legacy_rules, writer_rules

# Fields and vocabularies of the configuration format.
ROOT_FIELDS = {"pdf", "pages", "toc_pages", "long_edge", "pdftoppm_command", "workers", "verify", "ignore_hash_validation", "printed_page_offset", "resume", "redo_pages", "codex_review", "pdf_writer", "model_profiles", "model_usage", "translation"}
EFFORTS = ("minimal", "low", "medium", "high", "xhigh")
IMAGE_MODES = ("never", "on_demand", "always")
DETAILS = ("auto", "low", "high", "original")
PROFILE_FIELDS = {"provider", "model", "api_key_name", "chat_endpoint", "responses_endpoint", "enable_thinking", "max_tokens"}
ROLES = {"layout_ocr": "chat_endpoint", "primary_ocr": "chat_endpoint", "ocr_verifier": "responses_endpoint"}
TRANSLATION_FIELDS = {"provider", "endpoint", "source_lang", "target_lang", "formality", "glossary_id", "style_id", "context", "custom_instructions", "oauth_callback_port", "oauth_keychain_service", "oauth_keychain_account", "node_command", "bridge_script"}
BACKFILL_NAMES = {"output_filename": "translated.pdf", "final_translation_filename": "chapter_translation_final.json", "plan_filename": "pdf_backfill_plan.json", "report_filename": "pdf_backfill_report.json", "spotcheck_filename": "ai_spotcheck_request.json"}
OPTIONAL_NAMES = ("human_translation_overrides_filename", "layout_overrides_filename")


def _text(raw: Mapping, name: str, default: str) -> str:
    value = str(raw.get(name, default)).strip()
    if not value:
        raise ConfigError(f"{name} must not be empty")
    return value


def _choice(raw: Mapping, name: str, allowed: tuple[str, ...], default: str) -> str:
    value = str(raw.get(name, default)).strip()
    if value not in allowed:
        raise ConfigError(f"{name} must be one of: {', '.join(allowed)}")
    return value


@dataclass(frozen=True)
class ReviewSettings:
    """How a reviewer is asked; ``of`` reads the section and accepts the older switch for images."""

    command: str
    model: str
    reasoning_effort: str = "high"
    timeout_seconds: int = 1800
    image_mode: str = "on_demand"
    require_login: bool = True
    toc_image_detail: str = "high"
    exclude_preliminary: bool = False
    exclude_back_matter: bool = True
    ignore_hash_validation: bool = False

    @classmethod
    def of(cls, config: Mapping, command: str = "codex", model: str = "default", older: bool = False) -> ReviewSettings:
        """``older`` is the page reviewer's section, which knows ``include_image``."""
        fields = {"command", "model", "reasoning_effort", "timeout_seconds", "image_mode", "require_chatgpt_login", "toc_image_detail", "exclude_preliminary", "exclude_back_matter"}
        raw = C.closed(config.get("codex_review", {}), fields | ({"include_image"} if older else set()), "codex_review")
        if older and "include_image" in raw:
            if "image_mode" in raw:
                raise ConfigError("give image_mode or include_image, not both")
            raw = raw | {"image_mode": "always" if C.strict_flag(raw, "include_image") else "never"}
        seconds = raw.get("timeout_seconds", cls.timeout_seconds)
        try:
            seconds = 0 if isinstance(seconds, bool) else int(seconds)
        except (TypeError, ValueError):
            seconds = 0
        if seconds < 1:
            raise ConfigError("timeout_seconds must be a positive integer")
        return cls(
            command=_text(raw, "command", command),
            model=_text(raw, "model", model),
            reasoning_effort=_choice(raw, "reasoning_effort", EFFORTS, cls.reasoning_effort),
            timeout_seconds=seconds,
            image_mode=_choice(raw, "image_mode", IMAGE_MODES, cls.image_mode),
            require_login=C.strict_flag(raw, "require_chatgpt_login", True),
            toc_image_detail=_choice(raw, "toc_image_detail", DETAILS, cls.toc_image_detail),
            exclude_preliminary=C.strict_flag(raw, "exclude_preliminary", False),
            exclude_back_matter=C.strict_flag(raw, "exclude_back_matter", True),
            ignore_hash_validation=C.strict_flag(config, "ignore_hash_validation"),
        )


@dataclass(frozen=True)
class Profile:
    """A model behind an endpoint."""

    name: str
    provider: str
    model: str
    api_key_name: str
    chat_endpoint: str = ""
    responses_endpoint: str = ""
    enable_thinking: bool | None = None
    max_tokens: int = 16384
    api_key: str = field(default="", repr=False)

    @classmethod
    def of(cls, name: str, raw: object, keys: Mapping[str, str]) -> Profile:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]{0,79}", name):
            raise ConfigError(f"invalid profile name: {name!r}")
        label = f"model_profiles.{name}"
        given = C.closed(raw, PROFILE_FIELDS, label)
        texts = {k: str(given.get(k, "")).strip() for k in ("provider", "model", "api_key_name", "chat_endpoint", "responses_endpoint")}
        if not (texts["provider"] and texts["model"]):
            raise ConfigError(f"{label} needs a provider and a model")
        if texts["api_key_name"] not in keys:
            raise ConfigError(f"{label} names an unknown key: {texts['api_key_name']}")
        if any(e and not e.startswith("https://") for e in (texts["chat_endpoint"], texts["responses_endpoint"])):
            raise ConfigError(f"{label}: endpoints must use https")
        thinking = given.get("enable_thinking")
        if thinking is not None and not isinstance(thinking, bool):
            raise ConfigError(f"{label}.enable_thinking must be true, false or null")
        return cls(name=name, enable_thinking=thinking, max_tokens=int(C.number_in(given, "max_tokens", 1024, 65536, cls.max_tokens)), api_key=keys[texts["api_key_name"]], **texts)


def profiles_by_role(config: Mapping, keys: Mapping[str, str], chosen: Mapping[str, str | None] | None = None, defaults: Mapping[str, str] | None = None) -> dict[str, Profile]:
    """The profile of each role; names given on the command line go before the configuration's, those before the defaults."""
    given = config.get("model_profiles", {})
    if not isinstance(given, dict):
        raise ConfigError("model_profiles must be an object")
    known = {name: Profile.of(str(name), raw, keys) for name, raw in given.items()}
    names = dict(defaults or {}) | C.closed(config.get("model_usage", {}), set(ROLES), "model_usage") | {r: n for r, n in (chosen or {}).items() if n}
    out = {}
    for role, endpoint in ROLES.items():
        if names.get(role) not in known:
            raise ConfigError(f"model_usage.{role} names an unknown profile: {names.get(role)}")
        out[role] = known[names[role]]
        if not getattr(out[role], endpoint):
            raise ConfigError(f"the profile of {role} has no {endpoint}")
    return out


@dataclass(frozen=True)
class RunSettings:
    """What the reading stage takes from a configuration file."""

    pdf: Path | None
    pages: str | None
    long_edge: int
    workers: int
    verify: str
    resume: bool
    redo_pages: str | None
    printed_page_offset: int | None
    ignore_hash_validation: bool
    translation: Mapping
    config: Mapping

    @classmethod
    def load(cls, path: Path, root: Path) -> RunSettings:
        config = C.load(path, ROOT_FIELDS)
        for section in ("codex_review", "pdf_writer", "model_profiles", "model_usage", "translation"):
            if not isinstance(config.get(section, {}), dict):
                raise ConfigError(f"{section} must be an object")
        translation = C.closed(config.get("translation", {}), TRANSLATION_FIELDS, "translation")
        if translation.get("provider", "deepl_mcp") != "deepl_mcp":
            raise ConfigError("translation.provider must be deepl_mcp")
        pdf, offset = config.get("pdf"), config.get("printed_page_offset")
        if offset is not None and (isinstance(offset, bool) or not isinstance(offset, int)):
            raise ConfigError("printed_page_offset must be an integer")
        return cls(
            pdf=C.project_path(pdf, root, "pdf") if pdf else None,
            pages=config.get("pages"),
            long_edge=int(C.number_in(config, "long_edge", 512, 16384, 2048)),
            workers=int(C.number_in(config, "workers", 1, 4, 2)),
            verify=_choice(config, "verify", ("auto", "always", "never"), "auto"),
            resume=C.strict_flag(config, "resume"),
            redo_pages=config.get("redo_pages"),
            printed_page_offset=offset,
            ignore_hash_validation=C.strict_flag(config, "ignore_hash_validation"),
            translation=translation,
            config=config,
        )


@dataclass(frozen=True)
class WriterSettings:
    font_file: Path | None
    rules: Mapping

    @classmethod
    def of(cls, config: Mapping, root: Path) -> WriterSettings:
        raw = C.closed(config.get("pdf_writer", {}), {"font_file", "rules"}, "pdf_writer")
        font = raw.get("font_file")
        given = raw.get("rules")
        if given is not None and not isinstance(given, dict):
            raise ConfigError("pdf_writer.rules must be an object")
        return cls(C.project_path(font, root, "font_file") if font else None, writer_rules(given))


@dataclass(frozen=True)
class BackfillSettings:
    """The older writer's output names, font and rules."""

    names: Mapping[str, Path | None]
    font_file: Path
    rules: Mapping

    @classmethod
    def of(cls, config: Mapping, output: Path, root: Path) -> BackfillSettings:
        raw = C.closed(config.get("pdf_backfill", {}), {*BACKFILL_NAMES, *OPTIONAL_NAMES, "font_file", "rules"}, "pdf_backfill")
        names: dict[str, Path | None] = {n: output / _text(raw, n, default) for n, default in BACKFILL_NAMES.items()}
        names |= {n: output / v if (v := str(raw.get(n, "")).strip()) else None for n in OPTIONAL_NAMES}
        return cls(names, C.project_path(_text(raw, "font_file", "assets/fonts/font.ttf"), root, "font_file"), legacy_rules(raw.get("rules")))

    def of_pages(self, label: str | None) -> BackfillSettings:
        """Outputs of some pages only carry their label before the suffix; inputs keep their names."""
        if not label:
            return self
        tagged = {n: p.with_name(f"{p.stem}-{label}{p.suffix}") if p and n in BACKFILL_NAMES else p for n, p in self.names.items()}
        return dataclasses.replace(self, names=tagged)


def discovered(arguments: list[str], root: Path) -> Path | None:
    """The configuration that the arguments name, else the project's own if there is one."""
    for k, x in enumerate(arguments):
        if x == "--config" and k + 1 < len(arguments):
            return Path(arguments[k + 1])
        if x.startswith("--config="):
            return Path(x.partition("=")[2])
    own = root / "config" / "pipeline.json"
    return own if own.is_file() else None


def page_document(page_json: str | None, page_markdown: str | None) -> Path:
    """The page's JSON document; an older Markdown name stands for the document beside it."""
    if (page_json is None) == (page_markdown is None):
        raise ConfigError("give the page's JSON document, or its Markdown name")
    return Path(page_json) if page_json else Path(page_markdown).with_suffix(".json")


def enter(root: Path) -> None:
    """Relative paths of the command line are the project's."""
    if Path.cwd().resolve() != root.resolve():
        os.chdir(root)
