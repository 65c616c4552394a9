"""Runs described by a file instead of arguments.

A run's file is JSON: an object of the command line's options by their names, ``set`` for
variables that stand as ``${name}`` in any text, and ``load`` for a list of files that are
read first, each overridden by what follows.
"""

from __future__ import annotations

import json
import os
import string


def read(path: str, given: dict[str, str] | None = None) -> dict:
    """Options of a run's file, its variables filled in; ``given`` variables take precedence."""
    with open(path, encoding="utf-8") as f:
        own = json.load(f)
    options: dict = {}
    variables: dict[str, str] = {}
    for other in own.pop("load", []):
        loaded = read(os.path.join(os.path.dirname(path), other), given)
        variables |= loaded.pop("set", {})
        options |= loaded
    variables |= own.pop("set", {}) | (given or {})
    options |= own
    fill = lambda v: string.Template(v).safe_substitute(variables) if isinstance(v, str) else v
    return {k: fill(v) for k, v in options.items()} | {"set": variables}
