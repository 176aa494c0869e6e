"""Training-data operators on documents, pages, conversations and embeddings.

One module per operator; ``queries`` registers them for the driver.  Nothing
outside this package imports it.
"""
