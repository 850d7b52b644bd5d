"""Helpers the base tests import; a module name of its own, since every folder's ``conftest`` shares one name."""


def rows(df, *cols):
    """Sorted list of tuples of the chosen columns."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
