"""The book jobs, put together from the operators."""
