"""Operators of a training-data pipeline.

* ``packing``   best-two-fit packing of documents into fixed-size sequences
* ``tokens``    token files with equal-length sequences and masks
* ``warc``      WARC archives as chunked record tables
* ``licenses``  canonical digest lookup of licence texts
* ``toxicity``  class-conditional Kneser-Ney scoring
* ``quality``   quality rules with risk-controlled cutoffs
* ``urls``      URL rules in a sorted digest array
* ``decontam``  benchmark decontamination by a prefix-filtered join
* ``html``      main text of web pages by text-to-tag ratios
* ``partenum``  n-gram Jaccard join by PartEnum signatures
* ``queries``   the registered queries and their SQL
"""
