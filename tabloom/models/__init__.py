"""Binary classifiers as MLlib estimators, and what is built around them."""
