"""Training-data operators: documents, pages and conversations at corpus scale.

One module per operator; ``queries`` registers them.  Nothing outside this
subpackage imports it.
"""
