"""What each source calls its fields: one declarative table that drives the normalisers."""

from __future__ import annotations

from furrow.data import load

#: For each source label: its own name, and for each target the source fields in order of preference.
SPECS: dict[str, dict] = load("feeds")["specs"]
#: Fields that the old normalisers looked for under names that their feeds don't use; compat mode does so again.
COMPAT: dict[str, dict] = load("feeds")["compat"]
#: The feed that covers all states.
NATIONAL: str = load("feeds")["national"]
