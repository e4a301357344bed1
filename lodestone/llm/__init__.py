"""Operations of a training-data pipeline (decontamination, language id,
token output, language-model scoring, quality, URL rules, deduplication,
SentencePiece, near-duplicate joins).  Nothing outside this subpackage
imports it; its registered queries are in ``queries.py``."""
