"""Silver and gold facts, floor positions and run checks, as lazy DataFrame plans."""
