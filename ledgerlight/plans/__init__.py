"""Marts wired from the raw tables, and the business reports over them."""
