"""DataFrame operators: cleaning, features, summaries, mixes, top-N, clustering, statistics."""
