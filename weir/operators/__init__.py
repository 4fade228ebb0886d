"""Batch operators. Most also accept a streaming DataFrame; those that need a
total order or a full pass over the data have a streaming twin in
``weir.streaming``."""
