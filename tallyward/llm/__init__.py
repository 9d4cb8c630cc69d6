"""Operators on training text: quality, URLs, tokens, repeats, chats, pages, fingerprints and mixing."""
