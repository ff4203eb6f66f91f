"""Readers for landed report files, station tables and observation folders."""
