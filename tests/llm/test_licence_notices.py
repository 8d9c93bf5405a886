from kestrel.llm.queries import op2_license_sentences

BSD_HEAD = """Copyright (c) 2020, A. Author

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
BSD2 = BSD_HEAD + BSD_TAIL
BSD3 = BSD_HEAD + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
""" + BSD_TAIL
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.
#
# You should have received a copy of the GNU General Public License
# along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""


def _reports(spark, docs_of, written, texts):
    rows = [(k, t, "s") for k, t in enumerate(texts)]
    got = {r[0]: tuple(r)[1:] for r in op2_license_sentences(spark, written(documents=docs_of(rows))).collect()}
    return [got[k] for k in range(len(texts))]


def test_rules_skip_unknown_sentences(spark, docs_of, written):
    got = _reports(spark, docs_of, written, [BSD2, BSD3, GPL, BSD3 + GPL])
    gpl = "GPLFree,GPLTerms,Version30,AnyLater,GPLWarranty,GPLReceived"
    assert got == [("BSD-2-Clause", "BSDRedistribute,BSDAsIs", 2, 0),
                   ("BSD-3-Clause", "BSDRedistribute,BSDEndorse,BSDAsIs", 3, 0),
                   ("GPL-3.0-or-later", gpl, 6, 0),
                   ("GPL-3.0-or-later,BSD-3-Clause", f"BSDRedistribute,BSDEndorse,BSDAsIs,{gpl}", 9, 0)]


APACHE = """/*
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */
"""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED.
"""
MPL = """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this
// file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
DUAL = "Released under the MIT License and, at your option, licensed under the Apache License, Version 2.0."


def test_all_identifiers_of_a_sentence(spark, docs_of, written):
    got = _reports(spark, docs_of, written, [APACHE, MIT, MPL, DUAL, MPL.replace("v. 2.0", "v.\n// 2.0"),
                                             "It is at v. Licensed under CC BY 4.0, licensed under CC BY 4.0"])
    assert got == [("Apache-2.0", "Apache2Grant,ApacheUse,ApacheCopy,ApacheAsIs,ApacheSee", 5, 0),
                   ("MIT", "MITPermission,MITNotice,MITAsIs", 3, 0),
                   ("MPL-2.0", "MPL2Grant", 1, 0),
                   ("Apache-2.0,MIT", "MITGrant,Apache2Grant", 2, 0),
                   ("MPL-2.0", "MPL2Grant", 1, 0),
                   ("CC-BY-4.0", "CCBYGrant,CCBYGrant", 2, 0)]


ORGANISATION = BSD_HEAD + """
3. Neither the name of Foo Inc. nor the names of its contributors may be used to endorse or promote
   products derived from this software without specific prior written permission.
""".replace("Inc.", "Inc") + BSD_TAIL.replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "FOO INC")
FAR = "Redistribution and use in source and binary forms. " + "Prose. " * 200 + "This software is provided by X as is."
NOT_MIT = "This work is not licensed under the MIT License."
GPL2 = GPL.replace("version 3", "version 2")
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.

You should have received a copy of the GNU Lesser General Public
License along with this library.
"""
AGPL = GPL.replace("GNU General", "GNU Affero General").replace("# GNU General", "# GNU Affero General")
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE.
"""
NOTICES = ((ORGANISATION, "BSD-3-Clause"), (FAR, ""), (NOT_MIT, ""), (GPL2, "GPL-2.0-or-later"), (LGPL, "LGPL-2.1-or-later"),
           (AGPL, "AGPL-3.0-or-later"), (ISC, "ISC"), ("// SPDX-License-Identifier: Apache-2.0\nint x;", "Apache-2.0"),
           ("# SPDX-License-Identifier: GPL-2.0-or-later\n", "GPL-2.0-or-later"),
           (GPL2.replace("2 of the License, or\n# (at your option) any later version", "2 of the License"), "GPL-2.0-only"))


def test_notices_in_spark_and_in_sql(spark, docs_of, written):
    """The notices as they are published; the SQL gives the same rows."""
    import duckdb

    from kestrel.llm.queries import ORACLE_SQL
    folder = written(documents=docs_of([(k, t, "s") for k, (t, _) in enumerate(NOTICES)], extra=False))
    got = {r.doc_id: r for r in op2_license_sentences(spark, folder).collect()}
    assert [got[k].licenses for k in range(len(NOTICES))] == [licence for _, licence in NOTICES]
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    want = con.execute(f"select doc_id, licenses, sentence_ids, n_sentences, unmatched from ({ORACLE_SQL['op2_license_sentences']})")
    assert sorted(map(tuple, got.values())) == sorted(want.fetchall())
