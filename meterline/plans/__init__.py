"""Jobs made of the models: monthly runs, data tests, reports."""
