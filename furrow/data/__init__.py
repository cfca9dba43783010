"""Values that must be as they are, read from files beside this module."""

from __future__ import annotations

import json
from functools import lru_cache
from importlib.resources import files


@lru_cache
def load(name: str) -> dict:
    return json.loads(files(__name__).joinpath(f"{name}.json").read_text(encoding="utf-8"))
