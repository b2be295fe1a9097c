"""Training-data operators: near duplicates, filters, mixing, packing, search
and token files. Nothing else in the library imports this subpackage.

* ``embed_dedup``   near-duplicate vectors (random-hyperplane tables)
* ``line_dedup``    fuzzy lines (min-hash windows and segments, or SimHash blocks; edit similarity)
* ``url_filter``    Bloom filter cascade over URL keys
* ``toxicity``      factorization machine over hashed terms
* ``packing``       variable-capacity best-fit sequence packing
* ``mixing``        hierarchical source budgets (DataFrame functions only)
* ``suffix_dedup``  repeated byte strings (suffix grouping)
* ``topk``          exact top-k over binary codes (multi-index hashing)
* ``ngram_join``    n-gram Jaccard join (count-vector R-tree)
* ``records``       length-delimited token records with an offset index
* ``filter_audit``  interaction of filters (sorted posting lists)
* ``window_packing``  windows of one length (non-negative least squares)
* ``importance``    target-distribution resampling (hashed n-grams)
"""
