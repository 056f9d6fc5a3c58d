"""DataFrame in, DataFrame out, apart from the few functions that write."""
