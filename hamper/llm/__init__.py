"""Operations of a training-data pipeline over documents, pages and embeddings.

Nothing else in the library imports this subpackage. Its registered queries and their
SQL are in ``queries``; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
