"""Writers: image files, multiscale arrays, recompressed archives, previews, pages, experiment folders."""
