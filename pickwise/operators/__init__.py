"""User-level table operators. Each takes DataFrames keyed by ``bundle`` and
returns a lazy DataFrame; none triggers an action."""
