"""Training-data operators (one module per numbered operator).

Nothing else in the library imports this subpackage; the entry module adds
its queries only when it can be imported.
"""
