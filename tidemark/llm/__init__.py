"""Operators of a training-data pipeline (documents, pages, vectors, chats).

Nothing else in the library imports this package.  ``entries`` registers one
query per operator; every operator module keeps a general interface of its own.
"""
