"""Registered queries over the driver tables: each takes (spark, sf_dir) and
returns a lazy DataFrame whose column names match its oracle SQL."""

from queries import completions, core, dashboard, galaxy, misc, normalized, silver, sources, star

REGISTRY = {}
for _mod in (core, silver, star, dashboard, sources, misc, normalized, completions, galaxy):
    REGISTRY.update(_mod.QUERIES)
