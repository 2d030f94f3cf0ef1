"""Training-data pipeline operators (documents, pages, benchmark).

One module per operator; ``catalog`` registers one query per operator and the
corpus pipeline. Nothing outside this subpackage imports it.
"""
