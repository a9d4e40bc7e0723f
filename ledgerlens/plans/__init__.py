"""The warehouse tables: staging, dimensions, intermediate tables and marts.

Every model is a function of a ``Warehouse`` that returns a lazy DataFrame;
lineage is the call graph, and Catalyst sees one plan unless a model was pinned
to a stored table.
"""
