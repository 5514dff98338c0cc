"""Training-data operators (WARC, near duplicates, packing, sharding, filters, mixing).

Nothing outside this folder imports it; the driver entry module adds its queries only if
it can be imported.
"""
