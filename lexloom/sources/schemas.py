"""Explicit schemas of the inputs; keys are those of the published datasets (fixed values)."""

LAW_TYPE, PLACEMENT_TYPE, CONTENT_TYPE = "právní-akt-znění", "právní-akt-znění-fragment", "právní-akt-fragment"

LAWS = ("`typ` string, `iri` string, `akt-citace` string, `akt-název-vyhlášený` string, `akt-iri` string, `znění-id` string, `znění-dokument-id` bigint, "
        "`znění-datum-účinnosti-od` string, `znění-datum-účinnosti-do` string, `znění-je-zrušen` boolean, `znění-ročník` int, `cis-esb-sbírka-položka` string, `cis-esb-podtyp-právní-akt` string")  # fmt: skip
PLACEMENTS = ("`typ` string, `iri` string, `znění-fragment-id` bigint, `znění-fragment-předek` string, `znění-fragment-citace` string, `znění-fragment-citace-text` string, "
              "`znění-fragment-označení-uzlu` string, `znění-fragment-eli` string, `znění-fragment-url` string, `znění-fragment-hierarchie` string, `znění-fragment-hierarchie-hex` string, "
              "`znění-dokument-id` bigint, `právní-akt-fragment` struct<`fragment-id`: bigint>, `právní-akt-odkaz` string, `právní-akt-komentář-fragmentu` string")  # fmt: skip
CONTENTS = "`typ` string, `iri` string, `fragment-id` bigint, `fragment-base-id` bigint, `fragment-text` string, `cis-esb-typ-fragmentu` string, `cis-esb-typ-fragmentu-položka` string"
ACTS = "`typ` string, `akt-citace` string, `akt-rok-předpisu` int, `akt-číslo-předpisu` string, `akt-sbírka-kód` string, `akt-název-vyhlášený` string, `právní-akt-znění` array<struct<`znění-dokument-id`: bigint>>"
BINARIES = "`typ` string, `binární-soubor-id` bigint, `binární-soubor-obsah` array<struct<`obsah-url`: string, `obsah-typ`: string, `cis-esb-typ-soubor-druh-obsahu-položka`: string>>"
LOOKUP_REPLY = "`dokumentBaseId` bigint, `staleUrl` string, `nazev` string, `chyby` array<struct<`kod`: string, `popis`: string>>"
DOWNLOAD_REPLY = "`pozadavekId` string, `id` string, `stavPozadavku` string, `nazevDokumentu` string, `chyby` array<struct<`kod`: string, `popis`: string>>"
SEARCH_REPLY = "`pocetCelkem` bigint, `seznam` array<struct<`staleUrl`: string, `nazev`: string, `kodDokumentuSbirky`: string, `stavDokumentuSbirky`: string, `datum`: string>>"
PHASES = ["not_started", "downloading", "downloaded", "processing", "done", "error", "scan"]
