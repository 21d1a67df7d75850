"""A project's text files: configuration, source list, variable list and foreign-function headers."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# ---- fixed values

#: Parameter types of foreign functions and their codes.
TYPES = {
    "pword": 0, "int": 1, "ISurface": 2, "IString": 3, "IWinMsg": 4, "ITimer": 5, "IUI": 6, "ISys3xDIB": 7, "ISys3xCG": 9, "ISys3xStringTable": 10, "ISys3xSystem": 13,
    "ISys3xMusic": 14, "ISys3xMsgString": 15, "ISys3xInputDevice": 16, "ISys3x": 17, "IConstString": 18,
}
MAX_PARAMETERS = 20
#: Values of sys_ver: the system's version and the page signature.
VERSIONS = {
    "3.5": ("3.5", "S351"), "3.6": ("3.6", "S360"), "3.8": ("3.8", "S380"), "3.9": ("3.9", "S380"), "S350": ("3.5", "S350"), "S351": ("3.5", "S351"), "153S": ("3.6", "153S"),
    "S360": ("3.6", "S360"), "S380": ("3.9", "S380"),
}
_YES, _NO = ("yes", "true", "on", "1"), ("no", "false", "off", "0")
SECTIONS = ("#SYSTEM35", "#DLLHeader")


class ProjectError(ValueError):
    pass


@dataclass
class Config:
    sys_ver: str = "3.9"
    sco_ver: str = "S380"
    encoding: str = "utf8"
    hed: str | None = None
    variables: str | None = None
    ald_basename: str | None = None
    output_ain: str | None = None
    output_dir: str | None = None
    ain_magic: str = "AINI"
    ain_version: int = 1
    disable_else: bool = False
    disable_ain_message: bool = False
    disable_ain_variable: bool = False
    old_SR: bool = False
    unicode: bool = False
    debug: bool = False


def truth(word: str, legacy: bool = False) -> bool:
    """legacy: every word is true, as an old reader of these files had it."""
    low = word.lower()
    if legacy or low in _YES:
        return True
    if low in _NO:
        return False
    raise ProjectError(f"no truth value: {word!r}")


def read_config(text: str, legacy_bool: bool = False) -> Config:
    """key = value lines; a value ends at its first blank; unknown keys are passed over."""
    out = Config()
    for key, value in re.findall(r"(?m)^([A-Za-z_]+)\s*=\s*(\S+)", text):
        if key == "sys_ver":
            if value not in VERSIONS:
                raise ProjectError(f"unknown version {value!r}")
            out.sys_ver, out.sco_ver = VERSIONS[value]
        elif key == "encoding":
            if value.lower() not in ("sjis", "utf8"):
                raise ProjectError(f"unknown encoding {value!r}")
            out.encoding = value.lower()
        elif key == "ain_magic":
            if value not in ("AINI", "AIN2"):
                raise ProjectError(f"unknown mark {value!r}")
            out.ain_magic = value
        elif key == "ain_version":
            out.ain_version = int(value)
        elif hasattr(out, key) and key != "sco_ver":
            setattr(out, key, truth(value, legacy_bool) if isinstance(getattr(out, key), bool) else value)
    return out


def write_config(config: Config) -> str:
    """sys_ver, and what differs from the defaults."""
    plain = Config()
    version = next(k for k, v in VERSIONS.items() if v == (config.sys_ver, config.sco_ver))
    lines = [f"sys_ver = {version}"]
    for key in Config.__dataclass_fields__:
        value = getattr(config, key)
        if key not in ("sys_ver", "sco_ver") and value != getattr(plain, key):
            lines.append(f"{key} = {str(value).lower() if isinstance(value, bool) else value}")
    return "\n".join(lines) + "\n"


def read_variables(text: str) -> list[str]:
    """One a line, its place is its number; blanks on the right and empty lines at the end go."""
    names = [line.rstrip() for line in text.split("\n")]
    while names and not names[-1]:
        names.pop()
    return names


def write_variables(names: list[str]) -> str:
    return "".join(f"{n}\n" for n in names)


@dataclass
class Hed:
    sources: list[str] = field(default_factory=list)
    headers: list[str] = field(default_factory=list)


def read_hed(text: str) -> Hed:
    """Files of the two sections; ';' begins a comment, 0x1a ends the list; the place of a source is its page."""
    out, now = Hed(), None
    for line in text.split("\n"):
        if line.startswith("\x1a"):
            break
        if line.startswith("#"):
            if line.rstrip() not in SECTIONS:
                raise ProjectError(f"unknown section {line.rstrip()!r}")
            now = out.sources if line.rstrip() == SECTIONS[0] else out.headers
            continue
        name = line.partition(";")[0].rstrip()
        if name and now is None:
            raise ProjectError("a file before any section")
        if name:
            now.append(name)
    return out


def write_hed(hed: Hed) -> str:
    parts = [SECTIONS[0], *hed.sources, *([SECTIONS[1], *hed.headers] if hed.headers else [])]
    return "\n".join(parts) + "\n"


_DECLARED = re.compile(r"\s*void\s+([A-Za-z_]\w*)\s*\(\s*(void\s*|(?:[A-Za-z_]\w*\s+[A-Za-z_]\w*\s*,?\s*)*)\)", re.A)
_NOTES = re.compile(r"//[^\n]*|;[^\n]*|/\*.*?\*/", re.S)


def read_hel(text: str) -> list[tuple[str, list[int]]]:
    """(function, parameter type codes) of `void name(type ident, ...)` declarations."""
    text, at, out = _NOTES.sub(" ", text).rstrip(), 0, []
    while at < len(text):
        m = _DECLARED.match(text, at)
        if not m:
            raise ProjectError(f"no declaration at character {at}")
        words = [] if m[2].strip() == "void" else [p.split()[0] for p in m[2].split(",") if p.strip()]
        if unknown := [w for w in words if w not in TYPES]:
            raise ProjectError(f"{m[1]}: unknown type {unknown[0]}")
        if len(words) > MAX_PARAMETERS:
            raise ProjectError(f"{m[1]}: too many parameters")
        out.append((m[1], [TYPES[w] for w in words]))
        at = m.end()
    return out


def write_hel(functions: list[tuple[str, list[int]]]) -> str:
    names = {v: k for k, v in TYPES.items()}
    return "".join(f"void {f}({', '.join(f'{names[t]} a{i}' for i, t in enumerate(types, 1)) or 'void'})\n" for f, types in functions)
