"""Operators over DataFrames: labels (category codes), sampling (exact seeded
split, stratified folds), selection (anti joins, top-k), metrics
(classification report, confusion matrix), grid (candidates, fold scores),
training (MLlib forests, grid search, pandas scorer), registry (run and model
tables), explain (partial dependence)."""
