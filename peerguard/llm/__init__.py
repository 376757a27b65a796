"""Operators of a training-data pipeline over documents, pages and benchmark
items. Nothing else in the library imports this subpackage; its queries are in
``catalog.py`` and the pipeline in ``corpus_pipeline.py`` at the top."""
