"""Helpers of the tests that import by name; ``conftest`` is no such module, each folder has its own."""


def rows(df, *cols):
    """Collected rows as tuples (all columns, or the given ones), in order."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
