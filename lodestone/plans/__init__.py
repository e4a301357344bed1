"""Pipelines built from the operators: staged ETL (etl), the model pipeline
(ml), crawl selection (crawl), and the registered queries with their SQL
twins (queries)."""
