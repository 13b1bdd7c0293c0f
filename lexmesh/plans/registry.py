"""All queries outside the training-data subpackage."""

from __future__ import annotations

from lexmesh.plans import algebra, evaluation, explore, further, gates, integrity, matching, problems

MODULES = (problems, explore, integrity, algebra, matching, evaluation, further, gates)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: text for m in MODULES for name, text in m.SQL.items()}
