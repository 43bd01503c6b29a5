"""Training-data operators (language ID, dedup, decontamination, packing, sharding, WARC, chat, nearest neighbours).

Nothing outside this subpackage imports it.
"""
