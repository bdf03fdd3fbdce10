"""Registered queries, one module per operator family."""


def groups():
    from recordlake.registry import checks, filters, graphs, reads, series, shapes, writes

    return [m.G for m in (reads, filters, shapes, writes, checks, graphs, series)]
