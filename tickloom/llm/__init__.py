"""Operators for training data of language and policy models; nothing outside this package imports it."""
