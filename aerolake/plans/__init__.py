"""Whole plans: the registered queries, layer materialisation and the pipeline run."""
