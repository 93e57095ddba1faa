"""Probes for outside programs, fonts and libraries; run on the driver."""

from __future__ import annotations

import importlib
import os
import shutil
import subprocess
from collections.abc import Callable, Iterable, Mapping
from pathlib import Path
from types import ModuleType


class Absent(RuntimeError):
    """A program, font or library is not there, or is not the right one."""


Run = Callable[[list[str]], str]


def output_of(command: list[str], seconds: float = 10, environment: Mapping[str, str] | None = None) -> str:
    """What a program prints, on either stream; raises Absent where it can't run."""
    try:
        done = subprocess.run(command, capture_output=True, text=True, encoding="utf-8", errors="replace", timeout=seconds, env=environment, check=False)
    except (OSError, subprocess.SubprocessError) as e:
        raise Absent(f"{command[0]}: {e}") from e
    return done.stdout + done.stderr


def renders_pages(command: Path | str, run: Run = output_of) -> bool:
    """Whether the rasteriser has the options that are needed."""
    try:
        told = run([str(command), "-h"])
    except Absent:
        return False
    return all(option in told for option in ("-scale-to", "-singlefile"))


def rasteriser(explicit: str | None = None, path: str | None = None, more: Iterable[Path] = (), run: Run = output_of) -> str:
    """The first rasteriser that has the options; the same file under several names is tried once."""
    folders = (os.environ.get("PATH", "") if path is None else path).split(os.pathsep)
    wanted = [Path(explicit).expanduser()] if explicit else [Path(f) / n for f in folders if f for n in ("pdftoppm", "pdftoppm.exe")] + list(more)
    tried: set[Path] = set()
    for candidate in wanted:
        if candidate.is_file() and (real := candidate.resolve()) not in tried:
            tried.add(real)
            if renders_pages(candidate, run):
                return str(candidate)
    raise Absent(f"no rasteriser with the options that are needed{': ' + explicit if explicit else ''}")


def page_counter(rasteriser_command: str, find: Callable[[str], str | None] = shutil.which) -> str:
    """The information tool beside the rasteriser, else the one on the path."""
    own = Path(rasteriser_command).resolve()
    names = ["pdfinfo", "pdfinfo.exe"]
    for name in reversed(names) if own.suffix.lower() == ".exe" else names:
        if own.with_name(name).is_file():
            return str(own.with_name(name))
    if found := find("pdfinfo"):
        return found
    raise Absent("pdfinfo")


def pdf_tools(configured: str | None, find: Callable[[str], str | None] = shutil.which, more: Iterable[Path] = ()) -> tuple[str, str]:
    """A rasteriser and the information tool in its folder: the configured one, the one on the path, then ``more``."""
    on_path = find("pdftoppm")
    for candidate in [*([Path(configured).expanduser()] if configured else []), *([Path(on_path)] if on_path else []), *more]:
        sibling = candidate.with_name("pdfinfo.exe" if candidate.suffix.lower() == ".exe" else "pdfinfo")
        if candidate.is_file() and sibling.is_file():
            return str(candidate.resolve()), str(sibling.resolve())
    raise Absent("pdftoppm and pdfinfo")


def command(name: str, find: Callable[[str], str | None] = shutil.which) -> str:
    """A program by its path, which must exist, or by its name."""
    path = Path(name).expanduser()
    if path.is_absolute() or path.parent != Path("."):
        if path.is_file():
            return str(path.resolve())
    elif found := find(name):
        return found
    raise Absent(name)


def environment_without(secrets: Iterable[str], environment: Mapping[str, str] | None = None) -> dict[str, str]:
    """The environment for a child process, without the keys that it must not see."""
    hidden = set(secrets)
    return {k: v for k, v in (os.environ if environment is None else environment).items() if k not in hidden}


def login_status(program: str, wanted: str | None, environment: Mapping[str, str] | None = None) -> str:
    """What ``program login status`` says; raises Absent where it fails, or does not say ``wanted``."""
    try:
        done = subprocess.run([program, "login", "status"], capture_output=True, text=True, encoding="utf-8", errors="replace", timeout=30, env=environment, check=False)
    except (OSError, subprocess.SubprocessError) as e:
        raise Absent(f"login status: {e}") from e
    said = "\n".join(x.strip() for x in (done.stdout, done.stderr) if x.strip())
    if done.returncode or (wanted and wanted.lower() not in said.lower()):
        raise Absent(f"not logged in as wanted: {said or 'nothing said'}")
    return said


def font(configured: Iterable[str | Path]) -> Path:
    """The first font file that exists."""
    for candidate in map(Path, configured):
        if candidate.is_file():
            return candidate
    raise Absent("font file")


def libraries(*names: str) -> tuple[ModuleType, ...]:
    """Optional libraries, imported when they are needed."""
    try:
        return tuple(map(importlib.import_module, names))
    except ImportError as e:
        raise Absent(f"library {e.name}") from e
