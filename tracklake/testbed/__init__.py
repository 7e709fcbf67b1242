"""Raw event tables derived from the given benchmark tables, and the registered queries."""
