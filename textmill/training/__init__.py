"""Trainers of tokenizers over tables of word types, which stay on the executors."""
