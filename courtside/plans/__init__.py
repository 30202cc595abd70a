"""Plans: normalize/derive pipeline, named queries, SQL templates, registry."""
