"""Training-data operators: media, packing, language ID, URL filters, chat, secrets,
BPE, licences, exact top-k search and near duplicates. Nothing outside imports this."""
