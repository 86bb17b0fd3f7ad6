"""Readers, landing writers and the mapping from raw tables to the domain's rows."""
