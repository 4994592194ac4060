"""strandplan: planning of fibre-access networks, and preparation of text corpora, as Spark plans."""
