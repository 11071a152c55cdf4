"""Readers for the files of a phasing run, and the tables written from them."""
