"""Whole flows made of operators: preparation pipelines and training runs."""
