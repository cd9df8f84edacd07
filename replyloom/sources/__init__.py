"""Readers, writers and the message view over turn tables."""
