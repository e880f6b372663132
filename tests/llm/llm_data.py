"""Paths and schemas of the training-data tests (the session fixture is the parent folder's)."""

SF01 = "/root/testdata/sf0.01"
SF1 = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
