"""Index locators: ``es://index[,index...][/type[,type...]][?option=value&...]``."""

from __future__ import annotations

import fnmatch
from dataclasses import dataclass, field
from urllib.parse import unquote

SCHEME = "es://"
ALL_INDICES = "_all"

# Option names and defaults a locator may carry.
OPTION_DEFAULTS = {"json": "false", "size": "1000", "q": "*", "id": "-1", "tasks": "100"}


def is_locator(path: str | None) -> bool:
    """True when ``path`` names an index rather than plain files."""
    return bool(path) and path.startswith(SCHEME)


@dataclass(frozen=True)
class Locator:
    indices: tuple[str, ...]
    types: tuple[str, ...] = ()
    options: dict[str, str] = field(default_factory=dict, compare=False)

    @classmethod
    def parse(cls, uri: str) -> Locator:
        if not is_locator(uri):
            raise ValueError(f"{uri!r} is not an es://index/type locator")
        path, _, query = uri[len(SCHEME):].partition("?")
        parts = [p for p in path.strip("/").split("/")] if path.strip("/") else []
        if len(parts) not in (1, 2) or not all(parts):
            raise ValueError(f"{uri!r} must name one index part and at most one type part")
        return cls(_names(parts[0]), _names(parts[1]) if len(parts) == 2 else (), _options(query))

    @classmethod
    def of(cls, value: Locator | str) -> Locator:
        return value if isinstance(value, Locator) else cls.parse(value)

    def option(self, name: str) -> str:
        return self.options.get(name, OPTION_DEFAULTS[name])

    @property
    def id_field(self) -> str | None:
        name = self.option("id")
        return None if name == OPTION_DEFAULTS["id"] else name

    @property
    def target(self) -> tuple[str, str]:
        """The single (index, type) a write needs."""
        if len(self.indices) != 1 or len(self.types) != 1:
            raise ValueError("a write needs exactly one index and one type")
        return self.indices[0], self.types[0]

    def covers(self, index: str, doc_type: str) -> bool:
        """Names may end in ``*`` to select an index family by prefix."""
        wanted = self.indices == (ALL_INDICES,) or any(fnmatch.fnmatchcase(index, i) for i in self.indices)
        return wanted and (not self.types or doc_type in self.types)


def _names(part: str) -> tuple[str, ...]:
    names = tuple(n.strip() for n in part.split(",") if n.strip())
    if not names:
        raise ValueError(f"no name in locator part {part!r}")
    return names


def _options(query: str) -> dict[str, str]:
    options = {}
    for pair in filter(None, query.split("&")):
        name, _, value = pair.partition("=")
        if name not in OPTION_DEFAULTS:
            raise ValueError(f"unknown locator option {name!r}")
        options[name] = unquote(value)
    return options
