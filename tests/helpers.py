"""What several test modules share: the given tables and rows as tuples."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]
