"""Training-data operators (tokenisation, search, filters, near copies, mixing).

Nothing outside this subpackage imports it.  Each operator lives in a module
of its own; ``registry`` collects the driver's queries.
"""
