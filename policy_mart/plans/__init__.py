"""The mart's loads and reports, put together from the operators."""
