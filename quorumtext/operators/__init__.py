"""DataFrame operators: speaker turns, integrity checks, text quality, speaker assembly."""
