"""Compositions of operators (the RAG flow) and the registered queries."""
