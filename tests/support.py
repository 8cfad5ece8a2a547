"""Helpers that the test modules of this folder share."""

SMALL = "/root/testdata/sf0.001"


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
