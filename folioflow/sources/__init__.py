"""Sources: office files, folders, batch records, and seams for readers that live outside the engine."""
