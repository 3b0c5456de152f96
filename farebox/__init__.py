"""Spark toolkit for event-style fact tables and the dimensions around them.

Layers, from the bottom up:

``functions``  Column -> Column helpers
``sources``    descriptors, readers, batch-versioned tables, scratch storage
``operators``  DataFrame -> DataFrame steps
``plans``      whole jobs: ingest, integrate, analytics, products, refresh
``streaming``  the update loader as a file stream
``registry``   every operator on the test tables, with its SQL equivalent
"""
