"""Settings from a file and the environment, and where the networks lie.

Defined cases
    * lines without ``=``, blank ones and comments are skipped; quotes around a value and blanks are dropped.
    * what the environment holds already is never overridden; a file that isn't there says nothing.
"""

from __future__ import annotations

import os
from collections.abc import MutableMapping
from pathlib import Path


def load_settings(path: str, environment: MutableMapping[str, str] | None = None) -> MutableMapping[str, str]:
    """The environment with the file's ``KEY=value`` lines added."""
    environment = os.environ if environment is None else environment
    lines = Path(path).read_text(encoding="utf-8").splitlines() if Path(path).is_file() else []
    for key, found, value in (line.partition("=") for line in map(str.strip, lines) if not line.startswith("#")):
        if found and key.strip():
            environment.setdefault(key.strip(), value.strip().strip("'\""))
    return environment


def networks_path(given: str | None, environment: MutableMapping[str, str], folder: str, variable: str = "GEOIP_DB") -> str | None:
    """The networks' file: the one given, else the environment's, else the folder's first in order of name; None without any."""
    if chosen := given or environment.get(variable):
        return chosen
    return next((str(p) for p in sorted(Path(folder).glob("*.csv"))), None)
