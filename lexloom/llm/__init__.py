"""Training-data operators.  Nothing outside this subpackage imports it, except the guarded entry module and corpus_pipeline."""
