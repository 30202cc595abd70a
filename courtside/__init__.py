"""courtside — league statistics on Spark.

Landed season-to-date snapshots (player averages, team standings, shot
attempts) become fixed-schema processed tables; named, parameterized
DataFrame queries answer leader boards, standings, playoff seeding,
shooting by zone and the dashboard's card and display tables.

Layout:
    sources/    landed CSV, processed tables, stand-in views over test tables
    functions/  Column-level helpers (coercion, labels, rates, display text)
    operators/  generic, domain-free DataFrame operators (top-k, rates, seeding, ...)
    plans/      normalize/derive pipeline, named queries, SQL templates, registry
    sinks/      landing writer, processed writer, manifest
    streaming/  incremental pickup of newly landed files
"""

__version__ = "0.1.0"
